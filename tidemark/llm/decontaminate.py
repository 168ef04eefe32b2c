"""Benchmark decontamination by a distributed positional inverted index of the documents.

The index is a table of segments, each over some megabytes of whole documents: its terms, how many postings each has, and
the postings, which are places in the segment's run of words, sorted by term and place. Segments are made where the
documents are read, without a shuffle, and written to the shared folder; a lost task makes its own segments again.

A test item becomes windows of consecutive words. In a segment, a window whose terms aren't all there is dropped at once;
for the others the list of the rarest term is taken, moved by the term's place in the window, and intersected with the
other terms' lists, moved likewise, in order of their lengths: what is left are exact occurrences. `near` walks outwards
from the rarest term instead, so that up to so many other words may stand between.

Items are read in blocks of bounded size from the shared folder: a task holds one block and one segment at a time, however
many items there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, entering, fresh_dir, open_fs, runs_of, small_batches, texts_of

#: Consecutive words of an item that make a window.
WINDOW = 10
#: Bytes of text of a segment, one longer document alone, and of a block of items; candidates that are looked at together.
SEGMENT, BLOCK, TOGETHER = 6 << 20, 8 << 20, 2_000_000

_BYTES = np.arange(256)
#: Bytes of words: digits, letters and all of a character beyond ASCII.
_IS_WORD = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x41) & (_BYTES <= 0x5A)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)

#: A row holds megabytes: row groups are closed after a few.
_ROWS = {"compression": "zstd", "parquet.block.size": 16 << 20, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1}

INDEX = "doc_id array<long>, n_words array<long>, terms array<string>, counts array<long>, postings binary"


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of all texts in turn, in lower case, and how many each text has."""
    return runs_of(texts, lambda data: _IS_WORD[data])


def _planes(x: np.ndarray) -> bytes:
    """Numbers below 2**32, all lowest bytes first: the higher ones are nearly all zero, so the file's compression takes them away."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _numbers(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _segment(ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    words, n = words_of(texts)
    coded = words.dictionary_encode()
    term = coded.indices.to_numpy()
    order = np.argsort(term.astype(np.uint16) if len(coded.dictionary) <= 1 << 16 else term, kind="stable")  # places of a term, rising
    counts = np.bincount(term, minlength=len(coded.dictionary))
    firsts = np.cumsum(counts) - counts
    steps = np.diff(order, prepend=0)
    steps[firsts] = order[firsts]
    one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
    columns = [one(ids.cast(pa.int64())), one(pa.array(n, pa.int64())), one(coded.dictionary.cast(pa.string())), one(pa.array(counts, pa.int64())), pa.array([_planes(steps)], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "terms", "counts", "postings"])


def build(docs: DataFrame, size: int = SEGMENT) -> DataFrame:
    """The index of docs (doc_id, text): a row a segment, in a table in the shared folder. Null texts have no words."""

    def segments(batches):
        entering("postings")
        for batch in batches:
            for at, part in texts_of(batch.column(1), size):
                yield _segment(batch.column(0).slice(at, len(part)), part)

    path = fresh_dir(docs.sparkSession, "postings")
    with small_batches(docs.sparkSession, 2000):
        docs.select("doc_id", "text").mapInArrow(segments, INDEX).write.options(**_ROWS).parquet(path)
    return docs.sparkSession.read.parquet(path)


class Segment:
    """A row of the index, opened."""

    def __init__(self, row: dict):
        self.n_words = row["n_words"].values.to_numpy() if len(row["n_words"]) else np.zeros(0, np.int64)
        self.ends = np.cumsum(self.n_words)
        self.terms, self.counts = row["terms"].values, row["counts"].values.to_numpy()
        self.firsts = np.cumsum(self.counts) - self.counts
        run = np.cumsum(_numbers(row["postings"].as_py()))
        before = np.concatenate([[0], run])[self.firsts] if len(self.firsts) else self.firsts
        self.places = run - np.repeat(before, self.counts)
        self.keys = (np.repeat(np.arange(len(self.counts)), self.counts) << 32) + self.places  # rising

    def doc(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, place, "right")


class Block:
    """Windows of some items: distinct ones, their terms, and which items each stands in."""

    def __init__(self, ids: list[str], texts: list[str | None], window: int | None):
        words, n = words_of(pa.array([t or "" for t in texts], pa.large_string()))
        coded = words.dictionary_encode()
        self.terms, codes, seen = coded.dictionary, coded.indices.to_numpy(), {}
        for item, (end, m) in enumerate(zip(np.cumsum(n).tolist(), n.tolist())):
            width = min(m, window or m)
            for at in range(end - m, end - width + 1) if m else ():
                seen.setdefault(codes[at : at + width].tobytes(), set()).add(item)
        self.ids = ids
        self.length = np.array([len(x) // codes.itemsize for x in seen], np.int64)
        self.codes = np.full((len(seen), max(self.length, default=1)), -1, np.int64)
        for k, x in enumerate(seen):
            self.codes[k, : self.length[k]] = np.frombuffer(x, codes.dtype)
        self.n_items = np.array([len(x) for x in seen.values()], np.int64)
        self.items = np.array([i for x in seen.values() for i in sorted(x)], np.int64)
        self.first_item = np.cumsum(self.n_items) - self.n_items


def _ragged(first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers, each n times, and first, first + 1, ... of each row."""
    row = np.repeat(np.arange(len(n)), n)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)


def _candidates(s: Segment, b: Block) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(windows' terms in the segment, their order by rarity, window numbers, places of the rarest term), bounded stretches."""
    own = pc.index_in(b.terms, value_set=s.terms.cast(pa.large_string())).fill_null(-1).to_numpy().astype(np.int64)
    codes = np.where(b.codes >= 0, own[b.codes] if len(own) else -1, -2)
    alive = np.flatnonzero(~(codes == -1).any(1))
    lists = np.where(codes[alive] >= 0, s.counts[codes[alive]] if len(s.counts) else 0, np.iinfo(np.int64).max)
    order = np.argsort(lists, axis=1, kind="stable")
    n = lists[np.arange(len(alive)), order[:, 0]] if len(alive) else np.zeros(0, np.int64)
    rare = codes[alive, order[:, 0]] if len(alive) else n
    stretch = np.cumsum(n) // TOGETHER
    for a, e in zip(begins := np.flatnonzero(np.diff(stretch, prepend=-1)).tolist(), [*begins[1:], len(alive)]):
        # one window whose rarest list is long is cut as well
        row, at = _ragged(s.firsts[rare[a:e]], n[a:e])
        for k in range(0, len(row), TOGETHER):
            w = row[k : k + TOGETHER] + a
            yield codes[alive], order, (alive, w), s.places[at[k : k + TOGETHER]]


def exact(s: Segment, b: Block) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(windows, first places, last places) of all occurrences, by intersecting moved lists from the rarest on."""
    for codes, order, (alive, w), place in _candidates(s, b):
        start = place - order[w, 0]
        last = start + b.length[alive[w]] - 1
        ok = (start >= 0) & (last < len(s.places))
        w, start, last = w[ok], start[ok], last[ok]
        ok = s.doc(start) == s.doc(last)
        w, start, last = w[ok], start[ok], last[ok]
        for k in range(1, codes.shape[1]):
            at = order[w, k]
            term = codes[w, at]
            key = (term << 32) + start + at
            found = np.minimum(np.searchsorted(s.keys, key), len(s.keys) - 1)
            ok = (term < 0) | (s.keys[found] == key)
            w, start, last = w[ok], start[ok], last[ok]
            if not len(w):
                break
        if len(w):
            yield alive[w], start, last


def near(s: Segment, b: Block, slop: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """As exact(), of places where a window's words stand in their order with at most slop other words between, one for each place of the rarest.

    From a place of the rarest term, the nearest next term is taken on the right, then the next one, and so on the left:
    no other choice gives a shorter span.
    """
    for codes, order, (alive, w), place in _candidates(s, b):
        anchor, length = order[w, 0], b.length[alive[w]]
        first, last = place.copy(), place.copy()
        for step in range(1, codes.shape[1]):
            for side in (1, -1):
                at = anchor + side * step
                moving = (at >= 0) & (at < length)
                term, edge = codes[w, np.where(moving, at, 0)], last if side > 0 else first
                found = np.searchsorted(s.keys, (term << 32) + edge, "right" if side > 0 else "left") + (0 if side > 0 else -1)
                there = (found >= 0) & (found < len(s.keys))
                key = s.keys[np.clip(found, 0, len(s.keys) - 1)]
                good = there & ((key >> 32) == term)
                to = key & 0xFFFFFFFF
                if side > 0:
                    last = np.where(moving, to, last)
                else:
                    first = np.where(moving, to, first)
                ok = (~moving | good) & (last - first < length + slop)
                w, anchor, length, first, last = w[ok], anchor[ok], length[ok], first[ok], last[ok]
            if not len(w):
                break
        ok = s.doc(first) == s.doc(last)
        if ok.any():
            yield alive[w[ok]], first[ok], last[ok]


def _blocks(items: DataFrame, size: int) -> tuple[str, int]:
    """Items as files of at most about `size` bytes of text each in the shared folder; its path and their number. A longer item is alone in excess."""
    spark, path = items.sparkSession, fresh_dir(items.sparkSession, "items")
    items = cut(items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text"))
    n = 1 + int((items.agg(F.sum(F.octet_length("text") + 32)).first()[0] or 0) // size)
    items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)).cast("int")).repartition(n, "block").write.partitionBy("block").parquet(path)
    return path, n


_open: dict[tuple, Block] = {}


def _block(path: str, k: int, window: int | None) -> Block:
    """Read by the task that needs it; the last one is kept."""
    from pyarrow import fs
    from pyarrow import parquet as pq

    if (path, k, window) not in _open:
        _open.clear()
        files, base = open_fs(f"{path}/block={k}")
        names = sorted(x.path for x in files.get_file_info(fs.FileSelector(base, allow_not_found=True)) if x.path.endswith(".parquet"))
        tables = [pq.ParquetFile(files.open_input_file(x)).read(columns=["item_id", "text"]) for x in names]
        t = pa.concat_tables(tables).to_pydict() if tables else {"item_id": [], "text": []}
        _open[path, k, window] = Block(t["item_id"], t["text"], window)
    return _open[path, k, window]


def _over(index: DataFrame, items: DataFrame, window: int | None, answer, schema: str, size: int) -> DataFrame:
    """answer(segment, row, blocks) for each segment."""
    path, n = _blocks(items, size)

    def run(batches):
        entering("postings", _open.clear)
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k] for name in ("doc_id", "n_words", "terms", "counts", "postings")}
                yield from answer(Segment(row), row["doc_id"].values, (_block(path, x, window) for x in range(n)))

    return index.mapInArrow(run, schema)


def matches(index: DataFrame, items: DataFrame, window: int | None = WINDOW, slop: int | None = None, size: int = BLOCK) -> DataFrame:
    """doc_id, item_id, first, last (places of words in the document, from 0) of each occurrence of an item's windows (None: of the whole item).

    slop None: exact occurrences. Else also those with at most slop other words between the window's words, one for each
    place of the window's rarest term. Items (item_id, text) without words match nothing.
    """

    def answer(s, ids, blocks):
        for b in blocks:
            for w, first, last in exact(s, b) if slop is None else near(s, b, slop):
                hit, at = _ragged(b.first_item[w], b.n_items[w])
                doc = s.doc(first[hit])
                base = (s.ends - s.n_words)[doc]
                item = pa.array(b.ids, pa.string()).take(pa.array(b.items[at]))
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(doc)), item, pa.array(first[hit] - base), pa.array(last[hit] - base)], ["doc_id", "item_id", "first", "last"])

    with small_batches(index.sparkSession, 4):
        return cut(_over(index, items, window, answer, "doc_id long, item_id string, first long, last long", size))


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, size: int = BLOCK) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of each document, a row for a row.

    Words in any occurrence of a window are hit, once. Rows of items that share an item_id are one item; a null item_id is
    the empty one. Null and empty texts have no words, items without words no windows. Repeated documents each have a
    row, null doc_ids stay null. With no items nothing is hit; no documents give no rows. Other columns play no part.
    """

    def answer(s, ids, blocks):
        edges = np.zeros(len(s.places) + 1, np.int64)
        found: dict[int, set[str]] = {}
        for b in blocks:
            for w, first, last in exact(s, b):
                np.add.at(edges, first, 1)
                np.add.at(edges, last + 1, -1)
                hit, at = _ragged(b.first_item[w], b.n_items[w])
                for pair in np.unique((s.doc(first[hit]) << 32) + b.items[at]).tolist():
                    found.setdefault(pair >> 32, set()).add(b.ids[pair & 0xFFFFFFFF])
        hits = np.concatenate([[0], np.cumsum(np.cumsum(edges[:-1]) > 0)])
        n_hit = hits[s.ends] - hits[s.ends - s.n_words]
        none = hashlib.sha256(b"").hexdigest()
        shas = [hashlib.sha256(",".join(sorted(found[d])).encode()).hexdigest() if d in found else none for d in range(len(n_hit))]
        items_of = [len(found.get(d, ())) for d in range(len(n_hit))]
        names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
        yield pa.RecordBatch.from_arrays([ids, pa.array(s.n_words), pa.array(n_hit), pa.array(items_of, pa.int64()), pa.array(shas, pa.string()), pa.array(n_hit > 0)], names)

    index = build(docs)
    with small_batches(docs.sparkSession, 4):  # rows are segments
        return cut(_over(index, items, window, answer, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean", size))
