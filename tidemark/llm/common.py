"""What the operators share: reading tables, the shared folder, cutting lineage, file systems."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word, wherever an operator counts or takes words: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Most rows, and bytes, that a side of a join may have for it to be broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir); where none is set, a temporary one, on a local master alone."""
    sc = spark.sparkContext
    path = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir")
    if not sc.getCheckpointDir():
        if not path and not re.match(r"local($|\[)", sc.master):
            raise ValueError("spark.checkpoint.dir isn't set: set it to a folder that driver and executors share")
        sc.setCheckpointDir(path or tempfile.mkdtemp(prefix="tidemark-"))
        path = sc.getCheckpointDir()
    return re.sub(r"^file:/+", "file:///", path)


def fresh_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Computes df once and cuts its lineage, in the shared folder, so that a lost executor costs no more than its own tasks."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """As cut(), by a Parquet table: for wide rows, whose columns are then read singly."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _width(name: str, kind: T.DataType) -> Column:
    """About how many bytes a column takes in a row."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.octet_length(name) + F.lit(16)
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.octet_length(F.to_json(F.struct(name))) + F.lit(32)
    return F.lit(8)


def small(df: DataFrame, limit: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint if it has at most `limit` rows and about `size` bytes; else df, which Spark then joins by a shuffle. df should be cheap to count."""
    width = sum((F.coalesce(_width(f"`{f.name}`", f.dataType), F.lit(16)) for f in df.schema.fields), F.lit(16))
    rows, bytes_ = df.limit(limit + 1).agg(F.count(F.lit(1)), F.sum(width)).first()
    return F.broadcast(df) if rows <= limit and (bytes_ or 0) <= size else df


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that df has no column of, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def numbered(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """df with each row's place, from 0, in the order of all rows: sorted ranges are counted, and the counts before a range added up.

    No task gets more than its range; what meets on the driver is a count for each. The rows should be narrow: they are kept.
    """
    part, place = free_names(df, "_range", "_place")
    placed = cut(df.orderBy(*order).withColumn(part, F.spark_partition_id()).withColumn(place, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    counts = {r[0]: r[1] for r in placed.groupBy(part).count().collect()}
    before, firsts = 0, []
    for k in sorted(counts):
        firsts.append((k, before))
        before += counts[k]
    first = placed.sparkSession.createDataFrame(firsts or [(0, 0)], f"`{part}` int, `{name}` long")
    return placed.join(F.broadcast(first), part).withColumn(name, F.col(name) + F.col(place)).select(*df.columns, name)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000):
    """While an action runs, Arrow batches have at most so many rows: for stages whose Python workers hold much besides."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def open_fs(uri: str):
    """File system and path of a URI in the shared folder, from the driver or from a task."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


#: Bytes of text that a task works on at once, a longer text alone.
CHUNK_BYTES = 4 << 20
_caches: dict[str, list] = {"user": [None], "drop": []}


def texts_of(column, size: int = CHUNK_BYTES):
    """(place of the first, texts) of stretches of an Arrow column of texts, nulls as empty texts, so that what is made of them stays small."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    stretch = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)) // size
    begins = [0, *(np.flatnonzero(np.diff(stretch)) + 1).tolist(), len(column)]
    for a, b in zip(begins, begins[1:]):
        if a < b:
            yield a, pa.concat_arrays([pc.fill_null(column.slice(a, b - a).cast(pa.large_string()), "")])
            release()


def bytes_of(texts):
    """The bytes of an Arrow array of large strings, and where each text begins and ends in them."""
    import numpy as np

    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def runs_of(texts, inside_of):
    """All runs of bytes for which inside_of(bytes) holds, of all texts in turn, A-Z in lower case, and how many each text has."""
    import numpy as np
    import pyarrow as pa

    data, edges = bytes_of(texts)
    inside = inside_of(data)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = edges[:-1][edges[:-1] < len(data)]
    first[begins] = inside[begins]  # texts touch in the bytes
    at = np.flatnonzero(first)
    kept = data[inside]
    kept = np.where((kept >= 0x41) & (kept <= 0x5A), kept + np.uint8(32), kept)
    offsets = np.append((np.cumsum(inside) - 1)[at], len(kept)).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(kept)]), np.diff(np.searchsorted(at, edges))


def release() -> None:
    """Gives memory that isn't in use back to the system: a worker lives on between tasks, next to its executor."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def entering(user: str, drop=None) -> None:
    """Called by tasks that use much memory: what another kind of task has kept in this worker goes; drop frees this kind's."""
    if _caches["user"][0] != user:
        for f in _caches["drop"]:
            f()
        _caches["user"][0] = user
    if drop and drop not in _caches["drop"]:
        _caches["drop"].append(drop)
    release()
