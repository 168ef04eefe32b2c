"""Best-fit packing of token sequences by patterns, fitted to the histogram of lengths with non-negative least squares.

Only the histogram (a count for each length up to the capacity) meets on the driver, whatever the number of documents.
There it becomes runs: a composition of lengths and how many sequences have it. A document finds its place by its rank
among those of its length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, free_names, small, small_batches
from .tokens import default_path, encoder

#: Ranks are counted within groups of at most about so many pieces.
RANK_GROUP = 500_000


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 400) -> np.ndarray:
    """x >= 0 with least |a x - b|, by an active set: columns enter by gradient, leave when they would turn negative."""
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    for _ in range(rounds):
        gradient = np.where(active, -np.inf, a.T @ (b - a @ x))
        if gradient.max(initial=-np.inf) <= 1e-9 * max(1.0, np.abs(b).max()):
            break
        active[gradient.argmax()] = True
        while True:
            z = np.zeros_like(x)
            z[active] = np.linalg.lstsq(a[:, active], b, rcond=None)[0]
            bad = active & (z <= 1e-12)
            if not bad.any():
                x = z
                break
            step = np.min(x[bad] / np.maximum(x[bad] - z[bad], 1e-300))
            x = np.maximum(x + step * (z - x), 0)
            active &= x > 1e-12
            x[~active] = 0
    return x


def patterns(cells: int, most: int) -> list[tuple[int, ...]]:
    """Falling tuples of at most `most` whole numbers from 1 that add up to `cells`."""
    out: list[tuple[int, ...]] = []

    def grow(left: int, largest: int, got: tuple[int, ...]) -> None:
        if not left:
            out.append(got)
        elif len(got) < most:
            for n in range(min(left, largest), 0, -1):
                grow(left - n, n, (*got, n))

    grow(cells, cells, ())
    return out


def runs_of(histogram: dict[int, int], capacity: int, cells: int = 64, most: int = 4) -> list[tuple[list[tuple[int, int]], int]]:
    """Packs a histogram of lengths: [(composition as (length, times), number of such sequences)].

    Lengths are rounded up to `cells` units; patterns of at most `most` documents fill all units. Their repeat counts
    are fitted by non-negative least squares and rounded down, true lengths take the units' places, and what is left
    goes, longest first, to where it leaves the least room.
    """
    unit = -(-capacity // cells)
    full = -(-capacity // unit)
    left: dict[int, list[list[int]]] = defaultdict(list)  # by units: lengths that are left, longest last
    for length in sorted(histogram):
        left[-(-length // unit)].append([length, histogram[length]])
    want = np.zeros(full + 1)
    for n, lots in left.items():
        want[n] = sum(c for _, c in lots)
    bins: dict[int, list[tuple[list[tuple[int, int]], int]]] = defaultdict(list)  # by free room
    free: list[int] = []

    def put(room: int, run: tuple[list[tuple[int, int]], int]) -> None:
        if not bins[room]:
            insort(free, room)
        bins[room].append(run)

    if want.sum():
        shapes = patterns(full, most)
        a = np.zeros((full + 1, len(shapes)))
        for k, shape in enumerate(shapes):
            for n in shape:
                a[n, k] += 1
        times = np.floor(nnls(a, want / want.sum()) * want.sum() + 1e-6).astype(np.int64)
        for k in sorted(np.flatnonzero(times), key=lambda k: -times[k]):
            shape = shapes[k]
            need = {n: shape.count(n) for n in set(shape)}
            todo = int(min([times[k], *(sum(c for _, c in left[n]) // m for n, m in need.items())]))
            while todo > 0:
                # one true length for each kind of unit, for as many sequences as the scarcest of these lengths allows
                c = min([todo, *(left[n][-1][1] // m for n, m in need.items())])
                if c:
                    run = [(left[n][-1][0], m) for n, m in need.items()]
                    for n, m in need.items():
                        left[n][-1][1] -= c * m
                else:  # too few of a length for one sequence: mixed lengths
                    c, run = 1, []
                    for n, m in need.items():
                        for _ in range(m):
                            while not left[n][-1][1]:
                                left[n].pop()
                            run.append((left[n][-1][0], 1))
                            left[n][-1][1] -= 1
                put(capacity - sum(length * m for length, m in run), (run, c))
                todo -= c
                for n in need:
                    while left[n] and not left[n][-1][1]:
                        left[n].pop()
    for length, c in sorted(((length, c) for lots in left.values() for length, c in lots), reverse=True):
        while c:
            at = bisect_left(free, length)
            room = free[at] if at < len(free) else capacity
            fits = room // length
            run, n = bins[room].pop() if at < len(free) else ([], max(1, c // fits))
            if at < len(free) and not bins[room]:
                free.pop(at)
            fits = min(fits, c)
            used = min(n, c // fits)
            if used < n and run:
                put(room, (run, n - used))
            put(room - fits * length, ([*run, (length, fits)], used))
            c -= used * fits
    return [run for room in sorted(bins) for run in bins[room]]


def places(runs: list[tuple[list[tuple[int, int]], int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset), by length and rank: as far as the next row, ranks and sequences go up together."""
    rank: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for run, n in runs:
        offset = 0
        for length, times in run:
            for _ in range(times):
                rows.append((length, rank[length], sequence, offset))
                rank[length] += n
                offset += length
        sequence += n
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pieces(docs: DataFrame, capacity: int, path: str | None = None, end_id: int = 1) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each document's ids and end_id, cut where they are longer than capacity."""

    def encode(batches):
        enc = encoder(path or default_path())
        end, step = np.array([end_id], "<u4").tobytes(), 4 * capacity
        for batch in batches:
            ids, out = batch.column(0).to_pylist(), ([], [], [], [], [])
            for doc, raw in zip(ids, enc.encode(batch.column(1))):
                raw = raw.tobytes() + end
                for k, at in enumerate(range(0, len(raw), step)):
                    part = raw[at : at + step]
                    for to, x in zip(out, (doc, k, at // 4, len(part) // 4, zlib.crc32(part))):
                        to.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(encode, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(rows: DataFrame, capacity: int, order: list[str]) -> DataFrame:
    """rows (with a length from 1 to capacity) with sequence_id and offset.

    `order` makes ranks the same in each run; rows that tie in all of it are interchangeable. A length that a third of
    all rows have is ranked in many groups, whose counts then give each group's first rank.
    """
    spark = rows.sparkSession
    histogram = {r[0]: r[1] for r in rows.groupBy("length").count().collect()}  # at most `capacity` rows
    groups = max(8, sum(histogram.values()) // RANK_GROUP)
    table = spark.sparkContext.broadcast(places(runs_of(histogram, capacity)))
    group, first, place, rank = free_names(rows, "_group", "_first", "_local", "_rank")
    rows = rows.withColumn(group, F.pmod(F.xxhash64(*order), F.lit(groups)).cast("int"))
    counts = cut(rows.groupBy("length", group).agg(F.count(F.lit(1)).alias(first)))
    full = counts.filter(F.col(first) > 4 * RANK_GROUP)
    if not full.isEmpty():  # many rows tie in all of the order: which of them comes first doesn't matter, so their group is split
        more = free_names(rows, "_more")[0]
        full = full.select("length", group, F.ceil(F.col(first) / RANK_GROUP).cast("int").alias(more))
        part = F.pmod(F.monotonically_increasing_id(), F.coalesce(F.col(more), F.lit(1)))
        rows = cut(rows.join(F.broadcast(full), ["length", group], "left").withColumn(group, F.col(group) + groups * part.cast("int")).select(*rows.columns))
        counts = rows.groupBy("length", group).agg(F.count(F.lit(1)).alias(first))
    before = Window.partitionBy("length").orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("length", group, F.coalesce(F.sum(first).over(before), F.lit(0)).alias(first))
    local = F.row_number().over(Window.partitionBy("length", group).orderBy(*order)) - 1
    ranked = rows.withColumn(place, local).join(small(cut(firsts)), ["length", group])
    ranked = ranked.select(*rows.columns[:-1], (F.col(first) + F.col(place)).cast("long").alias(rank))

    def find(batches):
        t = table.value
        key = (t[:, 0] << 48) + t[:, 1]
        for batch in batches:
            length, at = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("length", rank))
            row = t[np.searchsorted(key, (length << 48) + at, "right") - 1]
            own = [batch.column(n) for n in kept]
            yield pa.RecordBatch.from_arrays([*own, pa.array(row[:, 2] + at - row[:, 1]), pa.array(row[:, 3])], names)

    kept = rows.columns[:-1]
    names = [*kept, "sequence_id", "offset"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return ranked.mapInArrow(find, f"{schema}, sequence_id long, offset long")


def packed(docs: DataFrame, capacity: int = 4096, path: str | None = None, end_id: int = 1) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of every document.

    A null or empty text is the end id alone. Repeated rows are packed each. Null doc_ids stay null. An empty table
    gives an empty one. Texts of any length are encoded whole; docs' other columns play no part, whatever their names.
    Rows that tie in doc_id, piece and ids are interchangeable. Texts are encoded once, where they are read; only rows of
    six numbers are shuffled.
    """
    with small_batches(docs.sparkSession, 2000):
        cut_up = cut(pieces(docs, capacity, path, end_id))
    return pack(cut_up, capacity, ["doc_id", "piece", "ids_crc32"])
