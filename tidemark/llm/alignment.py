"""Which tokens of two tokenizers stand for the same text, through a dictionary of groups.

Both tokenizers encode a text; where tokens of both end at the same byte, the text is cut into groups. A text's links are
the pairs of an A and a B token that overlap; the stretches between ends of any token are one link each.

1. Where texts are read, they are cut into chunks that neither tokenizer's tokens cross, and only distinct chunks of some
   megabytes are encoded, many in one call. Each document leaves its distinct groups, by key, with their frequencies;
   each distinct group leaves its links and how many documents have it; each pair of ids how many documents link it.
2. Groups are interned by key over the corpus (keys that two groups share are found, and others taken), pairs added up.
3. Links are expanded once for each distinct group and meet the pairs' counts there.
4. Documents meet their groups' results by key: the groups that most documents have by a broadcast of bounded size, so
   that no key is hot, the others by a shuffle.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bytes_of, entering, fresh_dir, small, small_batches, stored, texts_of

#: Bytes of text whose distinct chunks are encoded together; bytes of chunks in one call.
STRETCH, CALL = 1 << 20, 8 << 10
#: Most groups whose results are broadcast.
BROADCAST_GROUPS = 400_000
_SHIFT = 20

PARTS = "kind int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, keys array<long>, times array<long>, key long, text string, links array<long>, n long"
_PROBES = ("a b", "it's  x\n\ny  <|endoftext|> \t z\n <s>", "\n1 2\n", "x  y   z", "日本 語 ñ' 's 12 34.5", "w  ", "  a")


def _cumulated(n: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(n)]).astype(np.int64)


def _distinct(x: np.ndarray) -> np.ndarray:
    """Sorted, each value once."""
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def _ragged(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first, first + 1, ... n times, for each row."""
    return np.arange(int(n.sum())) + np.repeat(first - np.cumsum(n) + n, n)


def _lists(edges: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.LargeListArray.from_arrays(pa.array(edges, pa.int64()), values)


def _solid(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a character that surely isn't white space ends at these bytes."""
    one, two, three = data[at], data[np.maximum(at - 1, 0)], data[np.maximum(at - 2, 0)]
    white = (two == 0xC2) & ((one == 0x85) | (one == 0xA0))
    white |= ((three == 0xE2) & ((two == 0x80) | (two == 0x81))) | ((three == 0xE3) & (two == 0x80)) | ((three == 0xE1) & (two == 0x9A))
    return ((one > 0x20) & (one < 0x7F)) | ((one >= 0x80) & ~white)


class Aligner:
    """Encodes chunks by a byte-level file of tokenizers (A) and a sentencepiece model (B)."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer, pre_tokenizers

        self.a, self.b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True  # a special token's string in a text is plain text
        # bytes of ids: A writes each byte as one character of a fixed alphabet
        alphabet, letter = sorted(pre_tokenizers.ByteLevel.alphabet()), {}
        plain = [c for c in alphabet if ord(c) < 256]
        letter |= {c: ord(c) for c in plain}
        letter |= dict(zip((c for c in alphabet if ord(c) >= 256), (k for k in range(256) if chr(k) not in letter)))
        names = {i: w for w, i in self.a.get_vocab().items()}
        self.len_a = np.array([len(names.get(i, "")) for i in range(max(names) + 1)], np.int64)
        assert set(letter.values()) == set(range(256))
        raw = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            raw.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.len_b = np.array([len(x) for x in raw], np.int64)
        self.pool, self.first_b = np.frombuffer(b"".join(raw), np.uint8), _cumulated(self.len_b)
        self.space, self.split = self.b.piece_to_id("▁"), True
        self.split = all(self._same(t) for t in _PROBES)

    def _same(self, text: str) -> bool:
        chunks, _ = self.chunks(pa.array([text], pa.large_string()))
        a, _, b, _, ok = self.encode(chunks)
        return not ok.all() or (a.tolist() == self.a.encode(" " + text, add_special_tokens=False).ids and b.tolist() == self.b.encode(text))

    def chunks(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Chunks of a space and each text in turn, and how many each text has. Texts aren't empty.

        A chunk begins with a space or a line feed that follows another character than white space: pre-tokens of A and
        pieces of B begin there too.
        """
        data, edges = bytes_of(pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string())))
        at = np.flatnonzero((data == 0x20) | (data == 0x0A)) if self.split else edges[:0]
        at = at[_solid(data, at - 1)]
        begins = _distinct(np.concatenate([at, edges[:-1]]))
        ends = pa.py_buffer(np.append(begins, len(data)).astype(np.int64))
        return pa.Array.from_buffers(pa.large_string(), len(begins), [None, ends, pa.py_buffer(np.ascontiguousarray(data))]), np.diff(np.searchsorted(begins, edges))

    def _call(self, parts: list[str]) -> tuple[list, list]:
        """Ids of texts that begin with a space or line feed, without the space that B puts before them; B puts none before nothing."""
        a = [x.ids for x in self.a.encode_batch_fast(parts, add_special_tokens=False)]
        b = self.b.encode([t[1:] if t[0] == " " else t for t in parts], num_threads=1)
        return a, [[self.space] if t == " " else x if t[0] == " " else x[1:] for t, x in zip(parts, b)]

    def encode(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids of A, their last bytes' places, ids of B, theirs, which chunks both give back byte for byte); others have no ids."""
        data, edges = bytes_of(chunks)
        n = len(chunks)
        alone = ~_solid(data, edges[1:] - 1) if n else np.zeros(0, bool)
        # a call's chunks are neighbours; one that may end in white space is alone
        call = np.cumsum(np.concatenate([[True], alone[1:] | alone[:-1] | (np.diff(edges[:-1] // CALL) > 0)])) if n else edges[:0]
        begins = np.flatnonzero(np.diff(call, prepend=0))
        out, ok = ([], [], [], []), np.ones(n, bool)
        self._runs(data, edges, list(zip(begins.tolist(), [*begins[1:].tolist(), n])), out, ok)
        joined = [np.concatenate([np.zeros(0, np.int64), *x]) for x in out]
        if not ok.all():  # chunks whose call failed were encoded again, before others of the calls made with it
            for k in (0, 2):
                order = np.argsort(joined[k + 1], kind="stable")
                joined[k], joined[k + 1] = joined[k][order], joined[k + 1][order]
        return *joined, ok

    def _runs(self, data, edges, runs, out, ok) -> None:
        raw = data.tobytes()
        for k in range(0, len(runs), 256):
            part = runs[k : k + 256]
            for (x, y), a, b in zip(part, *self._call([raw[edges[x] : edges[y]].decode() for x, y in part])):
                a, b = np.array(a, np.int64), np.array(b, np.int64)
                ends_a, ends_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
                size = edges[y] - edges[x]
                good = len(b) and ends_a[-1] == size and ends_b[-1] == size
                if good:
                    good = np.array_equal(self.pool[_ragged(self.first_b[b], self.len_b[b])], data[edges[x] : edges[y]])
                    inner = edges[x + 1 : y] - edges[x]
                    good = good and all(np.array_equal(e[np.searchsorted(e, inner)], inner) for e in (ends_a, ends_b))
                if good:
                    for to, values in zip(out, (a, ends_a + edges[x], b, ends_b + edges[x])):
                        to.append(values)
                elif y - x > 1:
                    self._runs(data, edges, [(z, z + 1) for z in range(x, y)], out, ok)
                else:
                    ok[x] = False


_aligners: dict[tuple, Aligner] = {}


def _aligner(*paths: str) -> Aligner:
    entering("alignment", _aligners.clear)
    if paths not in _aligners:
        _aligners[paths] = Aligner(*paths)
    return _aligners[paths]


def _hash(ids: np.ndarray, group: np.ndarray, edges: np.ndarray, base: int) -> np.ndarray:
    """A polynomial of each group's ids."""
    power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(np.diff(edges).max(initial=0)), np.uint64(base))]), dtype=np.uint64)
    value = ids.astype(np.uint64) + np.uint64(1)
    return np.add.reduceat(value * power[np.arange(len(ids)) - edges[group]], edges[:-1], dtype=np.uint64) if len(ids) else np.zeros(0, np.uint64)


def _stretch(aligner: Aligner, ids: pa.Array, texts: pa.Array, seed: int):
    """Rows of PARTS for some documents."""
    some = np.flatnonzero(pc.binary_length(texts).to_numpy() > 0)
    chunks, n_chunks = aligner.chunks(texts.take(pa.array(some)))
    coded = chunks.dictionary_encode()
    code, distinct = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    a, ends_a, b, ends_b, ok = aligner.encode(distinct)
    chunk_ends = bytes_of(distinct)[1][1:]
    links = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")  # rising ends, merged
    twice = links[1:] == links[:-1]
    cuts, links = links[1:][twice], links[np.append(True, ~twice)] if len(links) else links
    pair = (a[np.searchsorted(ends_a, links)] << _SHIFT) + b[np.searchsorted(ends_b, links)] if len(links) else links
    # groups and what stands in each
    group_a, group_b, group_link = (np.searchsorted(cuts, x) for x in (ends_a, ends_b, links))
    edges_a, edges_b, edges_link = (_cumulated(np.bincount(g, minlength=len(cuts))) for g in (group_a, group_b, group_link))
    key = _hash(a, group_a, edges_a, 0x9E3779B97F4A7C15 + 2 * seed) * np.uint64(0xD6E8FEB86659FD93) + _hash(b, group_b, edges_b, 0xC2B2AE3D27D4EB4F + 2 * seed)
    key = (key ^ (key >> np.uint64(31))).view(np.int64)
    keys, first, group = np.unique(key, return_index=True, return_inverse=True)
    # groups that have another's key aren't hidden: they are told as well
    same = [(np.diff(e) == np.diff(e)[first[group]]) for e in (edges_a, edges_b)]
    clash = ~(same[0] & same[1])
    for x, g, e in ((a, group_a, edges_a), (b, group_b, edges_b)):
        fine = ~clash[g]
        other = e[first[group[g]]] + np.arange(len(x)) - e[g]
        clash[g[fine][x[fine] != x[other[fine]]]] = True
    strings = lambda x, e: pc.binary_join(_lists(e, pa.array(x).cast(pa.large_string())), pa.scalar(",", pa.large_string()))
    text = pc.binary_join_element_wise(strings(a, edges_a), strings(b, edges_b), pa.scalar("|", pa.large_string()))
    # chunks: their groups and numbers of tokens
    edges_chunk = _cumulated(np.bincount(np.searchsorted(chunk_ends, cuts), minlength=len(distinct)))
    chunk_text = pc.binary_join(_lists(edges_chunk, text), pa.scalar(";", pa.large_string()))
    per_chunk = [np.bincount(np.searchsorted(chunk_ends, x), minlength=len(distinct)) for x in (ends_a, ends_b, cuts, links)]
    # documents
    doc = np.repeat(np.arange(len(some)), n_chunks)
    good = np.bincount(doc, ~ok[code], len(some)) == 0
    doc_edges = _cumulated(n_chunks)
    doc_text = pc.binary_join(_lists(doc_edges, chunk_text.take(pa.array(code))), pa.scalar(";", pa.large_string()))
    sums = np.zeros((4, len(texts)), np.int64)
    for k, x in enumerate(per_chunk):
        sums[k, some] = np.where(good, np.bincount(doc, x[code], len(some)), 0)
    shas = [""] * len(texts)
    for k in np.flatnonzero(good).tolist():
        shas[some[k]] = hashlib.sha256(doc_text[k].as_buffer()).hexdigest()
    kept = good[doc]
    n = np.diff(edges_chunk)[code[kept]]
    held, times = np.unique(np.repeat(some[doc[kept]], n) * max(len(keys), 1) + group[_ragged(edges_chunk[code[kept]], n)], return_counts=True)
    held_doc, held_group = np.divmod(held, max(len(keys), 1))
    held_edges = _cumulated(np.bincount(held_doc, minlength=len(texts)))
    yield {"kind": np.zeros(len(texts), np.int32), "doc_id": ids.cast(pa.int64()), "n_a": sums[0], "n_b": sums[1], "n_groups": sums[2], "n_links": sums[3], "groups_sha256": pa.array(shas, pa.string()), "keys": (held_edges, keys[held_group]), "times": (held_edges, times)}
    # distinct groups
    n_docs = np.bincount(held_group, minlength=len(keys))
    shown = np.concatenate([first, np.flatnonzero(clash)])
    n = np.diff(edges_link)[shown]
    yield {"kind": np.full(len(shown), 1, np.int32), "key": key[shown], "text": text.take(pa.array(shown)).cast(pa.string()), "links": (_cumulated(n), pair[_ragged(edges_link[shown], n)]), "n": n_docs[group[shown]]}
    # pairs: of one distinct group, they are in as many documents as it; of several, documents count once
    n = np.diff(edges_link)[first]
    of, linked = np.divmod(_distinct((np.repeat(np.arange(len(first)), n) << 2 * _SHIFT) + pair[_ragged(edges_link[first], n)]), 1 << 2 * _SHIFT)
    pairs, at, several = np.unique(linked, return_inverse=True, return_counts=True)
    total = np.bincount(at, n_docs[of] * (several[at] == 1), len(pairs)).astype(np.int64)
    shared = several[at] > 1
    of, at = of[shared], at[shared]
    edges_of = _cumulated(np.bincount(of, minlength=len(keys)))
    n = np.diff(edges_of)[held_group]
    more = _distinct(np.repeat(held_doc, n) * max(len(pairs), 1) + at[_ragged(edges_of[held_group], n)])
    total += np.bincount(more % max(len(pairs), 1), minlength=len(pairs)).astype(np.int64)
    yield {"kind": np.full(len(pairs), 2, np.int32), "key": pairs, "n": total}


def parts(docs: DataFrame, path_a: str, path_b: str, seed: int = 0) -> DataFrame:
    """What documents (kind 0), their distinct groups (1) and linked pairs (2) leave, as a table in the shared folder."""
    schema = docs.sparkSession.createDataFrame([], PARTS).schema

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        names, aligner = to_arrow_schema(schema), _aligner(path_a, path_b)
        for batch in batches:
            for at, part in texts_of(batch.column(1), STRETCH):
                for found in _stretch(aligner, batch.column(0).slice(at, len(part)), part, seed):
                    rows, columns = len(found["kind"]), []
                    for f in names:
                        x = found.get(f.name)
                        if isinstance(x, tuple):
                            x = pa.ListArray.from_arrays(pa.array(x[0], pa.int32()), pa.array(x[1], pa.int64()))
                        x = pa.nulls(rows, f.type) if x is None else x if isinstance(x, pa.Array) else pa.array(x)
                        columns.append(x.cast(f.type))
                    yield pa.RecordBatch.from_arrays(columns, names=names.names)

    path = fresh_dir(docs.sparkSession, "groups")
    with small_batches(docs.sparkSession, 1000):
        docs.select("doc_id", "text").mapInArrow(run, schema).write.partitionBy("kind").parquet(path)
    return docs.sparkSession.read.schema(PARTS).parquet(path)


def _interned(found: DataFrame) -> DataFrame | None:
    """key, links, n of each distinct group; None if two groups have one key."""
    groups = stored(found.filter("kind = 1").groupBy("key", "text", "links").agg(F.sum("n").alias("n")), "interned")
    rows, keys = groups.agg(F.count(F.lit(1)), F.count_distinct("key")).first()
    return groups.select("key", "links", "n") if rows == keys else None


def pair_counts(found: DataFrame) -> DataFrame:
    """pair, a, n, best: in how many documents each pair of ids is linked, and the highest such number of its A id."""
    pairs = stored(found.filter("kind = 2").groupBy(F.col("key").alias("pair")).agg(F.sum("n").alias("n")).withColumn("a", F.shiftright("pair", _SHIFT)), "pairs")
    best = pairs.groupBy("a").agg(F.max("n").alias("best"))
    return pairs.join(small(best), "a").select("pair", "a", "n", "best")


def _frequent(groups: DataFrame, most: int) -> int:
    """The least power of two so that at most `most` groups are in as many documents."""
    bins = {r[0]: r[1] for r in groups.groupBy(F.floor(F.log2("n")).alias("bin")).count().collect() if r[0] is not None}
    total, least = 0, max(bins, default=0) + 1
    for k in sorted(bins, reverse=True):
        total += bins[k]
        if total > most:
            break
        least = k
    return 1 << int(least)


def alignment(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, broadcast: int = BROADCAST_GROUPS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each document, a row for a row.

    Null and empty texts, and texts that an encoding doesn't give back byte for byte, have no tokens: zeros and ''.
    Repeated rows are documents each; null doc_ids stay null; an empty table gives an empty one. Texts of any length are
    encoded whole. Other columns play no part.
    """
    import public_tokenizers

    paths = path_a or public_tokenizers.path("byte_bpe_50k.json"), path_b or public_tokenizers.path("piece_bpe_32k.model")
    seed, groups = 0, None
    while groups is None:
        found = parts(docs, *paths, seed)
        groups, seed = _interned(found), seed + 1
    counted = small(stored(pair_counts(found), "pair-counts"))
    links = groups.select("key", F.explode("links").alias("pair")).join(counted, "pair")
    results = links.groupBy("key").agg(F.sum(F.when(links.n == links.best, 1).otherwise(0)).alias("n_best"), F.sum("n").alias("count_sum"))
    results = stored(results.join(groups.select("key", F.col("n").alias("n_docs")), "key").filter("n_docs > 0"), "group-results")
    least = _frequent(results.select(F.col("n_docs").alias("n")), broadcast)
    sums = ["n_best", "count_sum"]
    rows = found.filter("kind = 0").drop("kind", "key", "text", "links", "n").withColumn("row", F.monotonically_increasing_id())
    own = [c for c in rows.columns if c not in ("keys", "times", "row")]
    rows = rows.withColumn("group", F.explode_outer(F.arrays_zip("keys", "times"))).select("row", *own, F.col("group.keys").alias("key"), F.col("group.times").alias("times"))
    rows = rows.join(F.broadcast(results.filter(F.col("n_docs") >= least).select("key", *sums)), "key", "left")
    total = lambda df: df.groupBy("row").agg(*(F.any_value(c).alias(c) for c in own), *(F.coalesce(F.sum(F.col(c) * F.col("times")), F.lit(0)).alias(c) for c in sums))
    if least > 1:  # groups of fewer documents: many keys, none of them hot
        rare = rows.filter("key IS NOT NULL AND n_best IS NULL").drop(*sums).join(results.filter(F.col("n_docs") < least).select("key", *sums), "key")
        rows = rows.unionByName(rare)
    return total(rows).select("doc_id", "n_a", "n_b", "n_groups", "n_links", *sums, "groups_sha256")
