"""Exact similarity join of documents on word n-gram sets, by set-relation skipping; returns its connected components.

1. Each document's set of shingle hashes gets a digest; equal sets are one set from here on.
2. Sets are ordered with rare shingles first. Two sets can only link if they share a shingle of their prefixes: lists of
   (shingle, set, size, position) are the index.
3. Sets that stand in lists together are first compared with one set alone, the list's leader with whom they share most
   lists: its answer tells their component, bounds other answers, as Jaccard distance is a metric, and leaves what a set
   has more and less than its leader.
4. A list whose sets are all in one component by now holds nothing new and is left out; in others, the sets of the
   component that has most of it meet those of other components alone, not each other. Each list is cut into blocks by
   position: a block is skipped for a set whose own place and size leave too few shingles for a link with any of the
   block's, then within it all sizes out of reach, then pairs that the distances to a common leader or the number of
   common prefix shingles rule out.
5. All that is left is compared: a set's overlap with a leader is counted, and its overlap with each set like that leader
   is derived from it by the few shingles that these have more or less.
So no link between different components is lost, and a group of n near copies costs about n comparisons.

Shingle hashes have 64 bits. Sets are known by 128 bits; the few, if any, that agree in 64 get other numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, entering, free_names, small, small_batches, stored, texts_of

#: Shingles of so many, counted in one go, are looked through for frequent ones; LOCAL of them in one go make one frequent.
CHUNK, LOCAL = 2_000_000, 3
#: Most frequent shingles whose counts order the sets; all others count as rare. The order decides costs only.
MAX_FREQUENT = 250_000
#: Of a set's lists, so many first ones are looked at for a leader.
EARLY = 10
#: Members of a list that meet in one task; sets that are compared with one set in one task.
GROUP, PARTNERS = 512, 64
#: Entries of a list that are skipped together; lists that are as short are looked at many at a time.
BLOCK = 64
#: A shingle of so many sets has its list dealt out to several tasks from the start.
HOT = 5_000
_MIX = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD))


def _finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX[4]
    return h ^ (h >> np.uint64(29))


def shingle_sets(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """Each text's sorted distinct hashes of its n-word shingles; of the whole sequence if it has fewer words; none without words."""
    for _, part in texts_of(texts):
        lists = pc.ascii_split_whitespace(pc.ascii_lower(part))
        coded = lists.flatten().dictionary_encode()
        names = coded.dictionary.to_pylist()
        of = np.fromiter(map(xxhash.xxh64_intdigest, names), np.uint64, len(names))
        code = coded.indices.to_numpy()
        real = np.fromiter(map(len, names), np.int64, len(names))[code] > 0  # white space at an end leaves an empty word
        edges = np.concatenate([[0], np.cumsum(real)])[lists.offsets.to_numpy()]
        words = of[code[real]]
        h = np.zeros(max(0, len(words) - n + 1), np.uint64)
        for k in range(n if len(h) else 0):
            h = (h + words[k : len(words) - n + 1 + k]) * _MIX[k % 4]
        h = _finish(h)
        for s, e in zip(edges.tolist(), edges[1:].tolist()):
            if e - s >= n:
                yield np.unique(h[s : e - n + 1])
            elif e > s:
                short = np.uint64(e - s)
                with np.errstate(over="ignore"):
                    for w in words[s:e]:
                        short = (short + w) * _MIX[3]
                yield _finish(np.array([short]))
            else:
                yield words[:0]


def _digest(s: np.ndarray) -> tuple[int, int]:
    d = xxhash.xxh3_128_intdigest(s.tobytes())
    return (d >> 64) - (1 << 63), (d & (1 << 64) - 1) - (1 << 63)


class _Numbers:
    """A set's number: its digest's first half, or another one where sets share that."""

    def __init__(self, others: dict[tuple[int, int], int]):
        self.others = others

    def __call__(self, s: np.ndarray) -> int:
        d = _digest(s)
        return self.others.get(d, d[0]) if self.others else d[0]


def _batch(schema: str, *columns) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    parts = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, parts)], [x for x, _ in parts])


SCANNED = "doc_id long, key long, n int, hi long, lo long, shingle long, count long"
ENTRY = "shingle long, sid long, n int, pos int"
SIGNED = np.int64


def _scan(docs: DataFrame, words: int) -> DataFrame:
    """Rows of documents (doc_id, key, n, digest) and of shingles that are frequent in some chunk (shingle, count), in one reading."""

    def scan(batches):
        entering("join")
        held, size, known = [], 0, set()

        def frequent():
            got, n = np.unique(np.concatenate(held), return_counts=True)
            got, n = got[n >= LOCAL], n[n >= LOCAL]
            none = [None] * len(got)
            return _batch(SCANNED, none, none, none, none, none, got.view(SIGNED), n)

        for batch in batches:
            ids, ns, his, los = batch.column("doc_id"), [], [], []
            for s in shingle_sets(batch.column("text"), words):
                hi, lo = _digest(s)
                ns.append(len(s))
                his.append(hi)
                los.append(lo)
                if (hi, lo) not in known:  # copies don't make a shingle frequent
                    known.add((hi, lo))
                    held.append(s)
                    size += len(s)
                if size >= CHUNK:
                    yield frequent()
                    held, size, known = [], 0, set()
            none = [None] * len(ns)
            yield _batch(SCANNED, ids, batch.column("key"), ns, his, los, none, none)
        if size:
            yield frequent()

    return docs.select("doc_id", "key", "text").mapInArrow(scan, SCANNED)


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def _entries(docs: DataFrame, words: int, percent: int, numbers, order) -> DataFrame:
    """Prefix entries of each set, a set once a task; part is 0, or one of several for a hot shingle."""

    def scan(batches):
        entering("join")
        rare, counts = order.value
        number, seen = numbers.value, set()
        for batch in batches:
            out = ([], [], [], [], [])
            for s in shingle_sets(batch.column("text"), words):
                if len(s) and (sid := number(s)) not in seen:
                    if len(seen) < 200_000:
                        seen.add(sid)
                    k = prefix_length(len(s), percent)
                    at = np.searchsorted(rare, s)
                    at[at == len(rare)] = 0
                    count = np.where(rare[at] == s, counts[at], 0) if len(rare) else None
                    part = np.zeros(k, np.int64)
                    if count is not None and count.any():
                        first = np.lexsort((s, count))[:k]
                        own = s[first]
                        if (hot := count[first] // HOT).any():
                            part = np.where(hot > 0, 1 + (sid & 0xFFFFFF) % (hot + 1), 0)
                    else:
                        own = s[:k]
                    for to, x in zip(out, (own.view(SIGNED), np.full(k, sid), np.full(k, len(s)), np.arange(k), part)):
                        to.append(x)
            if out[0]:
                yield _batch(f"{ENTRY}, part int", *(np.concatenate(x) for x in out))

    return docs.select("text").mapInArrow(scan, f"{ENTRY}, part int")


def _lists(entries: DataFrame, parts: int) -> DataFrame:
    """Entries of lists of two sets at least, a set once a list. Of a list that goes on in the next batch, one row is kept.

    Lists of hot shingles come in parts, each in a task; that they have many sets is known.
    """

    def scan(batches):
        last = held = None  # the last row; the same if it wasn't sent, as it may be alone in its list
        for batch in batches:
            t, s, part = (batch.column(c).to_numpy() for c in ("shingle", "sid", "part"))
            batch = batch.select(["shingle", "sid", "n", "pos"])
            if not len(t):
                continue
            same = np.zeros(len(t), bool)  # list as the row before
            again = np.zeros(len(t), bool)  # and set
            same[1:] = (t[1:] == t[:-1]) & (part[1:] == part[:-1])
            again[1:] = same[1:] & (s[1:] == s[:-1])
            if last is not None:
                same[0] = (t[0], part[0]) == last[:2]
                again[0] = same[0] and s[0] == last[2]
            more = np.zeros(len(t), bool)  # another set of the list follows, or has been before
            new = same & ~again
            more[new] = True
            list_no = np.cumsum(~same)
            many = np.zeros(list_no[-1] + 1, bool)
            many[list_no[new]] = True
            many[list_no[part > 0]] = True
            if same[0] and many[0] and held is not None:  # another set follows here, though maybe after copies of this row
                yield held
                held = None
            if same[0]:
                many[0] = many[0] or held is None  # the list's rows before have been sent
            keep = many[list_no] & ~again
            if not many[list_no[-1]]:  # one set so far: it waits
                if not same[0] or list_no[-1] > 0:
                    at = len(t) - 1
                    while at > 0 and again[at]:
                        at -= 1
                    held = batch.slice(at, 1)
            else:
                held = None
            last = (t[-1], part[-1], s[-1])
            if keep.any():
                yield batch.filter(pa.array(keep))

    return entries.repartition(parts, "shingle", "part").sortWithinPartitions("shingle", "part", "sid").mapInArrow(scan, ENTRY)


def _prefixes(lists: DataFrame) -> DataFrame:
    """sid, n, items: each set's shingles that are in lists, in the order of all sets; at most a prefix long."""
    placed = F.array_sort(F.collect_list(F.struct("pos", "shingle")))
    return lists.groupBy("sid", "n").agg(F.transform(placed, lambda x: x["shingle"]).alias("items"))


def _entries_of(prefixes: DataFrame, *more: str) -> DataFrame:
    """shingle, sid, n, m, left and more: a row for each item, with how many there are, and how many from this one on."""
    rows = prefixes.select("sid", "n", *more, F.size("items").alias("m"), F.posexplode("items").alias("k", "shingle"))
    return rows.select("shingle", "sid", "n", *more, "m", (F.col("m") - F.col("k")).alias("left"))


def _may_link(c, n_a, n_b, percent: int):
    """Whether sets of these sizes with c common shingles in their prefixes can link.

    All common shingles up to the end of the prefix that ends first are among these c; beyond, that set has no more than
    its own rest, which is less than percent / 100 of it.
    """
    largest = F.greatest(n_a, n_b)
    rest = F.floor((percent * largest + 99) / 100) - 1
    return (c + rest) * (100 + percent) >= percent * (n_a + n_b)


ANSWER = "a long, b long, both int, n_a int, n_b int, less binary, more binary"


def _common(own: np.ndarray, s: np.ndarray) -> int:
    """How many of s are in own; both are sorted and distinct."""
    if not len(own):
        return 0
    at = np.searchsorted(own, s)
    at[at == len(own)] = 0
    return int((own[at] == s).sum())


def _verify(pairs: DataFrame, sets_of, parts: int, percent: int, told: DataFrame | None = None) -> DataFrame:
    """ANSWER of pairs (a, b): how many shingles both have.

    told has (b, home, less, more): what sets b have less and more than a set like them, their home. Where it knows b,
    a's overlap with the home is counted once and b's is derived from it. Else b's own set is compared, and less and
    more are returned, the difference of b from a, if the two are similar. a's set stands once for PARTNERS of
    those it is compared with, which pass by one at a time. sets_of gives (sid, items) joined to a table of sids.
    """
    if told is None:
        pairs = pairs.select("a", "b", F.col("b").alias("home"), *(F.lit(None).cast("binary").alias(c) for c in ("less", "more")))
    else:
        pairs = pairs.join(told, "b", "left").withColumn("home", F.coalesce("home", "b"))
    near = pairs.groupBy("a", "home").agg(F.count(F.lit(1)).alias("_c"))
    groups = near.groupBy("a").agg((F.sum("_c") / PARTNERS).cast("int").alias("_last"))
    near = near.filter(F.col("_c") > PARTNERS).select(F.col("a").alias("_a"), F.col("home").alias("_h"), (F.col("_c") / PARTNERS).cast("int").alias("_split"))
    dealt = pairs.join(groups, "a").join(small(near), (F.col("a") == F.col("_a")) & (F.col("home") == F.col("_h")), "left")
    turn = F.pmod(F.xxhash64("b"), F.coalesce("_split", F.lit(0)) + 1)
    dealt = stored(dealt.select("a", F.pmod(F.xxhash64("home", turn), F.col("_last") + 1).cast("int").alias("part"), "home", "b", "less", "more"), "pairs")
    # kind 0: a's own set; 1: a home's, with b if it is a partner itself; 2: a partner that is derived from its home
    heads = dealt.select(F.col("a").alias("sid"), "a", "part", F.lit(0).alias("kind"), *(F.lit(None).cast("long").alias(c) for c in ("home", "b"))).distinct()
    homes = dealt.groupBy("a", "part", "home").agg(F.max(F.when(F.col("home") == F.col("b"), F.col("b"))).alias("b"))
    homes = homes.select(F.col("home").alias("sid"), "a", "part", F.lit(1).alias("kind"), "home", "b")
    columns = ["a", "part", "kind", "home", "b"]
    met = sets_of(cut(heads.unionByName(homes))).select(*columns, "items", *(F.lit(None).cast("binary").alias(c) for c in ("less", "more")))
    met = met.unionByName(dealt.filter("home <> b").select("a", "part", F.lit(2).alias("kind"), "home", "b", F.lit(None).cast("binary").alias("items"), "less", "more"))
    differences = told is None

    def compare(batches):
        entering("join")
        key = own = shared = size = None
        for batch in batches:
            out = ([], [], [], [], [], [], [])
            for a, part, kind, home, b, items, less, more in zip(*(batch.column(c).to_pylist() for c in (*columns, "items", "less", "more"))):
                if kind == 0:
                    key, own = (a, part), np.frombuffer(items, np.uint64)
                    continue
                row = None
                if kind == 1 and key == (a, part):
                    s = np.frombuffer(items, np.uint64)
                    shared, size = _common(own, s), len(s)
                    if b is not None:
                        near = differences and 100 * shared >= percent * (len(own) + size - shared)
                        row = (a, b, shared, len(own), size, np.setdiff1d(own, s, assume_unique=True).tobytes() if near else None, np.setdiff1d(s, own, assume_unique=True).tobytes() if near else None)
                elif kind == 2 and key == (a, part):
                    less, more = np.frombuffer(less, np.uint64), np.frombuffer(more, np.uint64)
                    row = (a, b, shared - _common(own, less) + _common(own, more), len(own), size - len(less) + len(more), None, None)
                for to, x in zip(out, row or ()):
                    to.append(x)
            yield _batch(ANSWER, *out)

    met = met.repartition(parts, "a", "part").sortWithinPartitions("a", "part", F.asc_nulls_first("home"), "kind")
    return met.mapInArrow(compare, ANSWER)


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) of edges (a, b), by large and small stars in turn until nothing changes."""

    def state(e):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()

    e = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    before = None
    while (now := state(e)) != before:
        before = now
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        little = large.join(down, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = cut(little.union(down.select("a", F.col("m").alias("b"))).distinct())
    return e.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node").union(e.select("b", F.col("b").alias("c")).distinct())


def _long(entries: DataFrame) -> DataFrame:
    """shingle, most, mixed, holds, passes of lists of more than GROUP sets: the component that has most of them, whether others have some, parts of these, and of all."""
    long = cut(entries.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > GROUP).select("shingle"))
    counts = entries.join(small(long), "shingle").groupBy("shingle", "comp").agg(F.count(F.lit(1)).alias("c"))
    lists = counts.groupBy("shingle").agg(F.sum("c").alias("n"), F.max(F.struct("c", "comp")).alias("x"))
    return cut(lists.select("shingle", F.col("x.comp").alias("most"), (F.col("n") > F.col("x.c")).alias("mixed"), F.ceil((F.col("n") - F.col("x.c")) / GROUP).cast("int").alias("holds"), F.ceil(F.col("n") / GROUP).cast("int").alias("passes")))


def _blocks(held: dict[str, np.ndarray]) -> list[dict]:
    """Entries of a list by falling rest of their prefixes, BLOCK at a time, each by size, with the longest rest."""
    order = np.argsort(-held["left"], kind="stable")
    out = []
    for at in range(0, len(order), BLOCK):
        some = order[at : at + BLOCK]
        some = some[np.argsort(held["n"][some], kind="stable")]
        out.append({c: x[some] for c, x in held.items()} | {"rest": int(held["left"][some].max())})
    return out


def _reached(block: dict, rows: dict[str, np.ndarray], percent: int):
    """(place in the block, place in rows) of pairs that may link, some hundred thousand at once.

    Of a row, with as many list shingles from its place on as it has or the block has at most, sizes in the block are
    out of reach below and above a bound: for smaller sets as the larger one is given, for larger ones by the least
    that the bound on both can be. Larger sets only count for rows of the list's main component, which isn't held.
    """
    n, size = block["n"].astype(SIGNED), rows["n"].astype(SIGNED)
    m = np.minimum(block["rest"], rows["left"]).astype(SIGNED)
    rest = (percent * size + 99) // 100 - 1
    low = np.searchsorted(n * 100, percent * size, "left")
    high = np.searchsorted(n, np.minimum(size, (m + rest) * (100 + percent) // percent - size), "right")
    least = np.ceil((percent * size - m * (100 + percent)) * 100 / (percent * percent) - 1e-9)
    low2 = np.maximum(np.searchsorted(n, size, "right"), np.searchsorted(n, least, "left"))
    high2 = np.where(rows["main"] == 1, np.searchsorted(n * percent, size * 100, "right"), 0)
    both = np.arange(len(size))
    for begin, end in ((low, high), (low2, high2)):
        k = np.maximum(end - begin, 0)
        some = both[k > 0]
        ends = np.cumsum(k[some])
        at = 0
        while at < len(some):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 300_000, "right")))
            c = k[some[at:to]]
            j = np.repeat(some[at:to], c)
            yield np.arange(len(j)) - np.repeat(np.cumsum(c) - c, c) + np.repeat(begin[some[at:to]], c), j
            at = to


PAIR = "a long, b long, n_a int, n_b int"


def _within(rows: dict[str, np.ndarray], sizes: np.ndarray):
    """(place, place) of all pairs of each of several short lists that lie one after another, some hundred thousand at once."""
    first = np.repeat(np.cumsum(sizes) - sizes, sizes)
    before = np.arange(len(first)) - first
    ends = np.cumsum(before)
    at = 0
    while at < len(before):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 300_000, "right")))
        k = before[at:to]
        j = np.repeat(np.arange(at, to), k)
        yield np.arange(len(j)) - np.repeat(np.cumsum(k) - k, k) + first[j], j
        at = to


def _across(entries: DataFrame, percent: int, parts: int) -> DataFrame:
    """Pairs PAIR of different components that stand in lists together and may link; entries have left, comp, home, away.

    At two sets' first common list, they can't have more lists in common than either has left; pairs that would need
    more there don't link. In a list of more than BLOCK sets, those of other components than its main one are held, all
    pass by; in one of more than GROUP, both in parts of about GROUP. A long list of one component isn't dealt out.
    """
    rows = entries.join(small(_long(entries)), "shingle", "left").filter("mixed is null or mixed").withColumn("main", F.coalesce((F.col("comp") == F.col("most")).cast("int"), F.lit(0)))
    columns = ["shingle", "sid", "n", "left", "comp", "home", "away", "main"]
    place = lambda k: F.pmod(F.xxhash64("sid"), F.col(k)).cast("int")
    upto = lambda k: F.sequence(F.lit(0), F.col(k) - 1)
    # role 0: held; 1: passes by; 2: of a list that stays whole
    whole = rows.filter("mixed is null").select(*columns, F.lit(0).alias("part"), F.lit(2).alias("role"))
    held = rows.filter("mixed and main = 0").select(*columns, F.explode(F.transform(upto("passes"), lambda j: place("holds") * F.col("passes") + j)).alias("part"), F.lit(0).alias("role"))
    passing = rows.filter("mixed").select(*columns, F.explode(F.transform(upto("holds"), lambda i: i * F.col("passes") + place("passes"))).alias("part"), F.lit(1).alias("role"))
    share = percent / 100

    def kept(x, y, i, j, ordered: bool):
        """Of pairs (place in x, place in y), those that may link; if ordered, one of (p, q) and (q, p) of sets that are both held."""
        ok = x["comp"][i] != y["comp"][j]
        i, j = i[ok], j[ok]
        na, nb = x["n"][i].astype(SIGNED), y["n"][j].astype(SIGNED)
        most = np.maximum(na, nb)
        rest = (percent * most + 99) // 100 - 1
        ok = (100 * np.minimum(na, nb) >= percent * most) & ((np.minimum(x["left"][i], y["left"][j]) + rest) * (100 + percent) >= percent * (na + nb))
        if ordered:
            ok &= (y["main"][j] == 1) | (na < nb) | ((na == nb) & (x["sid"][i] < y["sid"][j]))
        ok &= (x["home"][i] != y["home"][j]) | (np.abs(x["away"][i] - y["away"][j]) <= 1 - share + 1e-9)
        return _batch(PAIR, x["sid"][i[ok]], y["sid"][j[ok]], na[ok], nb[ok]) if ok.any() else None

    def met(held, rows):
        for block in _blocks(held):
            for i, j in _reached(block, rows, percent):
                yield kept(block, rows, i, j, True)

    def scan(batches):
        entering("join")
        rest = None  # of the last list, which may go on

        def lists(d, last):
            """Pairs of all whole lists in d, and what is left of it."""
            edge = np.flatnonzero((d["shingle"][1:] != d["shingle"][:-1]) | (d["part"][1:] != d["part"][:-1])) + 1
            begins = np.concatenate([[0], edge])
            sizes = np.diff(np.concatenate([begins, [len(d["shingle"])]]))
            n = len(sizes) if last else len(sizes) - 1
            short = (sizes[:n] <= BLOCK) & (d["role"][begins[:n]] == 2)
            some = {c: d[c][: begins[n] if n < len(begins) else None][np.repeat(short, sizes[:n])] for c in columns}
            out = [kept(some, some, i, j, False) for i, j in _within(some, sizes[:n][short])]
            for a, size in zip(begins[:n][~short].tolist(), sizes[:n][~short].tolist()):
                one = {c: d[c][a : a + size] for c in columns}
                is_held = d["role"][a : a + size] == 0
                if d["role"][a] == 2:
                    names, counts = np.unique(one["comp"], return_counts=True)
                    one["main"] = (one["comp"] == names[counts.argmax()]).astype(np.int32)
                    is_held, passes = one["main"] == 0, np.ones(size, bool)
                else:
                    passes = ~is_held
                if is_held.any() and passes.any():
                    out += met({c: x[is_held] for c, x in one.items()}, {c: x[passes] for c, x in one.items()})
            return [x for x in out if x is not None], None if last else {c: x[begins[-1] :] for c, x in d.items()}

        for batch in batches:
            if not batch.num_rows:
                continue
            d = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in (*columns, "part", "role")}
            if rest is not None:
                d = {c: np.concatenate([rest[c], x]) for c, x in d.items()}
            found, rest = lists(d, False)
            yield from found
        if rest is not None:
            yield from lists(rest, True)[0]

    dealt = whole.unionByName(held).unionByName(passing).repartition(parts, "shingle", "part").sortWithinPartitions("shingle", "part")
    return dealt.mapInArrow(scan, PAIR).distinct()


def _may_link_exactly(pairs: DataFrame, prefixes: DataFrame, percent: int) -> DataFrame:
    """(a, b) of pairs (a, b, n_a, n_b) that can link by their number of common lists, counted on the sets' lists."""
    met = pairs.join(prefixes.select(F.col("sid").alias("a"), F.col("items").alias("_a")), "a").join(prefixes.select(F.col("sid").alias("b"), F.col("items").alias("_b")), "b")
    return met.filter(_may_link(F.size(F.array_intersect("_a", "_b")), F.col("n_a"), F.col("n_b"), percent)).select("a", "b")


def grouped(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, key (the text's hash), n, sid, comp of each document: the size and number of its set, and one set's number for each component."""
    with small_batches(docs.sparkSession, 2000):
        return _grouped(docs, words, percent)


def _grouped(docs: DataFrame, words: int, percent: int) -> DataFrame:
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("key"))
    scanned = stored(_scan(docs, words), "sets")
    members = scanned.filter("n is not null").select("doc_id", "key", "n", "hi", "lo")
    shared = members.filter("n > 0").select("hi", "lo").distinct()
    clash = shared.groupBy("hi").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").join(shared, "hi").select("hi", "lo").collect()
    others = {(r.hi, r.lo): xxhash.xxh64_intdigest(f"{r.hi} {r.lo}") - (1 << 63) for r in clash}  # none, as good as always
    numbers = spark.sparkContext.broadcast(_Numbers(others))
    sid = F.col("hi")
    for (hi, lo), other in others.items():
        sid = F.when((F.col("hi") == hi) & (F.col("lo") == lo), F.lit(other)).otherwise(sid)
    members = members.withColumn("sid", sid)
    frequent = scanned.filter("shingle is not null").groupBy("shingle").agg(F.sum("count").alias("count")).orderBy(F.desc("count"), "shingle").limit(MAX_FREQUENT).toPandas()
    tokens = frequent["shingle"].to_numpy(SIGNED).view(np.uint64)
    by = np.argsort(tokens)
    order = spark.sparkContext.broadcast((tokens[by], frequent["count"].to_numpy(SIGNED)[by]))

    prefixes = stored(_prefixes(_lists(_entries(docs, words, percent, numbers, order), parts)), "prefixes")
    lists = _entries_of(prefixes)
    least = members.filter("n > 0").groupBy("sid").agg(F.min(F.struct("doc_id", "key")).alias("x")).select("sid", F.col("x.doc_id").alias("_id"), F.col("x.key").alias("_key"))

    def take(batches):
        entering("join")
        given: set[int] = set()  # rows that share doc_id and text lie together: one of them gives the set
        for batch in batches:
            out, wanted = ([], []), batch.column("sid").to_pylist()
            number = numbers.value
            for s, want in zip(shingle_sets(batch.column("text"), words), wanted):
                if len(s) and want not in given and number(s) == want:
                    given.add(want)
                    out[0].append(want)
                    out[1].append(s.tobytes())
            yield _batch("sid long, items binary", *out)

    def sets_of(wanted: DataFrame) -> DataFrame:
        """wanted (sid and more) with items, the shingles of the set, made from one document each, known by its id and its text's hash: an id may be null or stand often."""
        picked = least.join(small(wanted.select("sid").distinct()), "sid")
        chosen = docs.join(small(cut(picked)), docs["doc_id"].eqNullSafe(F.col("_id")) & (docs["key"] == F.col("_key"))).select("sid", "text")
        return chosen.mapInArrow(take, "sid long, items binary").join(small(wanted), "sid")

    # a list's leader has most of its prefix in lists: of near copies, the one with the fewest changes of its own; a set's
    # first lists tell well enough whom it shares most with, and what they don't tell, the second round finds
    early = lists.filter(F.col("m") - F.col("left") < EARLY)
    rank = F.struct((F.col("m") / F.col("n")).alias("share"), "sid", "n")
    leads = early.groupBy("shingle").agg(F.max(rank).alias("x"), F.count(F.lit(1)).alias("_c")).filter("_c > 1").select("shingle", F.col("x.sid").alias("a"), F.col("x.n").alias("n_a"))
    met = early.select("shingle", F.col("sid").alias("b"), F.col("n").alias("n_b")).join(leads, "shingle").filter((F.col("a") != F.col("b")) & (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")))
    met = met.groupBy("a", "b", "n_a", "n_b").agg(F.count(F.lit(1)).alias("c"))
    best = met.groupBy("b", "n_b").agg(F.max(F.struct("c", "a", "n_a")).alias("x")).select("x.a", "b", "x.n_a", "n_b")
    best = cut(_may_link_exactly(best, prefixes, percent))
    first = stored(_verify(best, sets_of, parts, percent), "first")
    union = F.col("n_a") + F.col("n_b") - F.col("both")
    good = 100 * F.col("both") >= percent * union
    edges = first.filter(good).select("a", "b")
    found = cut(components(edges))
    homes = first.select(F.col("b").alias("sid"), F.col("a").alias("home"), (1 - F.col("both") / union).alias("away"))
    homes = homes.unionByName(first.select(F.col("a").alias("sid")).distinct().join(homes.select("sid"), "sid", "left_anti").select("sid", F.col("sid").alias("home"), F.lit(0.0).alias("away")))
    known = cut(found.withColumnRenamed("node", "sid").join(homes, "sid", "full"))
    told = prefixes.join(small(known), "sid", "left").select("sid", "n", "items", F.coalesce("component", "sid").alias("comp"), F.coalesce("home", "sid").alias("home"), F.coalesce("away", F.lit(0.0)).alias("away"))
    entries = stored(_entries_of(told, "comp", "home", "away").drop("m"), "entries")
    left = cut(_may_link_exactly(_across(entries, percent, parts), prefixes, percent))
    like = first.filter("less is not null").select("b", F.col("a").alias("home"), "less", "more")
    second = _verify(left, sets_of, parts, percent, like)
    found = cut(components(edges.union(second.filter(good).select("a", "b"))))
    for shared in (numbers, order):
        shared.unpersist()
    out = members.join(found.withColumnRenamed("node", "sid"), "sid", "left")
    return out.select("doc_id", "key", "n", "sid", F.coalesce("component", "sid").alias("comp"))


def linked(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id: documents link when their sets' Jaccard similarity is percent / 100 or more.

    component_id is the smallest doc_id that links reach. A text without words, or null, has an empty set and links with
    nothing; equal sets link, so repeated rows share a component; null doc_ids count for nobody's component_id but get
    one from others they link with. An empty table gives no rows. Texts of any length are cut into shingles whole; docs'
    other columns play no part, whatever their names; ties in any order only decide what is compared first.
    """
    members = grouped(docs, words, percent)
    first_id = members.filter("n > 0").groupBy("comp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("size"))
    out = members.join(small(cut(first_id.filter("size > 1").select("comp", "least"))), "comp", "left")
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("least", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """docs with one row of each component: that of the smallest doc_id, nulls last, of several texts under it that of the smallest hash.

    Of rows that share doc_id and text with the one that stays, one stays. Rows without a word, and null texts, link
    with nothing, so all of them stay. An empty table gives an empty one. docs' columns may have any names.
    """
    members = cut(grouped(docs, words, percent).filter("n > 0").groupBy("comp", "doc_id", "key").agg(F.count(F.lit(1)).alias("rows")))
    best = members.groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("x"), F.sum("rows").alias("all")).filter(F.col("all") > 1)
    best = cut(best.select(F.col("comp").alias("c"), F.col("x.doc_id").alias("i"), F.col("x.key").alias("k")))
    met = members.join(small(best), F.col("comp") == F.col("c"))
    stays = F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("key") == F.col("k"))
    i, k, key = free_names(docs, "_id", "_key", "_text")
    rows = docs.withColumn(key, F.xxhash64("text"))

    def those(df: DataFrame) -> DataFrame:
        return cut(df.select(F.col("doc_id").alias(i), F.col("key").alias(k)).distinct())

    def joined(df: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        return df.join(small(keys), F.col("doc_id").eqNullSafe(F.col(i)) & (F.col(key) == F.col(k)), how)

    kept = joined(rows, those(met.filter(~stays)), "left_anti")
    again = those(met.filter(stays & (F.col("rows") > 1)))
    if again.isEmpty():
        return kept.drop(key)
    one = joined(kept, again, "left_semi").dropDuplicates(["doc_id", "text"])
    return joined(kept, again, "left_anti").unionByName(one).drop(key)
