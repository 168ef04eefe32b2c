"""Paged sources over responses that have landed as files: a search by key and time, and mailboxes that grow.

A search answers for one key (an owner, a city) in pages of bounded size, each of which names the one after it. Landed, a
key has a folder of pages in the order of a time column, and the list of all pages, with the times they span, is a table
beside them. A scan filters the list, by Spark's own push-down, and opens the files that are left. (A Python data source
with pushFilters was tried: Spark 4.1 keeps the filters of one query for the next one on the same table, and that lost
rows.)

A mailbox is a folder of numbered batches for each account. The stream's offset is a number for each account; a
micro-batch reads what each account has between two of these numbers, and new accounts begin at nothing.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from .shared import cut

#: Rows of a page, as the services give them.
PAGE_ROWS = 100
#: Rows of a range that a task sorts, bytes of a mailbox's part, and shares that an account is dealt to.
RANGE_ROWS, PART_BYTES, SHARES = 1_000_000, 4_000_000, 32


def _fs(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or not uri.startswith("file:") else "file://" + uri.removeprefix("file:"))


def _load(uri: str) -> dict | list:
    files, path = _fs(uri)
    with files.open_input_stream(path) as f:
        return json.loads(f.read())


def _batch(rows: list[dict], schema):
    """Rows of JSON as an Arrow batch; texts become the column's type as a cast would have it."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    to = to_arrow_schema(schema)
    columns = []
    for f in to:
        cells = [r.get(f.name) for r in rows]
        columns.append(pa.array([c if c is None or not isinstance(c, str) or pa.types.is_string(f.type) else _cell(c, f.type) for c in cells], f.type))
    return pa.RecordBatch.from_arrays(columns, schema=to)


def _cell(text: str, kind):
    import datetime

    import pyarrow as pa

    if pa.types.is_timestamp(kind):
        at = datetime.datetime.fromisoformat(text.replace("Z", "+00:00"))
        return at if at.tzinfo else at.replace(tzinfo=datetime.timezone.utc)
    return datetime.date.fromisoformat(text[:10]) if pa.types.is_date(kind) else text


def land_pages(df: DataFrame, path: str, key: str, at: str, order: str, rows: int = PAGE_ROWS) -> None:
    """df as a search service's pages in a folder: for each key, pages by `at` (then `order`), and `pages`, their list with the times they span.

    All rows are sorted in ranges, and a row's place within its key comes of its place in its range and the counts of the
    ranges before: of a key, however large, no task sorts more than a range, or holds more than some pages.
    """
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // RANGE_ROWS))
    placed = df.repartitionByRange(n, key, at, order).sortWithinPartitions(key, at, order)
    placed = cut(placed.withColumn("_range", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    of_key = Window.partitionBy("_key")
    parts = placed.groupBy(F.col("_range").alias("_r"), F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    parts = parts.withColumns({"_before": F.sum("_n").over(of_key.orderBy("_r")) - F.col("_n"), "_last": F.floor((F.sum("_n").over(of_key) - 1) / rows).cast("int")}).drop("_n")
    paged = placed.join(parts, (F.col("_range") == F.col("_r")) & F.col(key).eqNullSafe(F.col("_key")))
    paged = paged.withColumn("_page", F.floor((F.col("_before") + F.col("_at") - F.col("_first")) / rows).cast("int")).repartition(n, key, "_page")
    cells = F.to_json(F.struct(*(F.col(c) for c in df.columns)))
    page = paged.groupBy(key, "_page").agg(F.min(at).alias("low"), F.max(at).alias("high"), F.first("_last").alias("_last"), F.array_sort(F.collect_list(F.struct(F.col(at).alias("a"), F.col(order).alias("o"), cells.alias("row")))).alias("_rows"))
    more = F.when(F.col("_page") < F.col("_last"), F.col("_page") + 1)
    results = F.concat(F.lit("["), F.array_join(F.transform("_rows", lambda x: x["row"]), ","), F.lit("]"))
    paging = F.when(F.col("_more").isNull(), F.lit("{}")).otherwise(F.concat(F.lit('{"next":{"after":"'), F.col("_more"), F.lit('"}}')))
    page = page.withColumn("_more", more).select(F.col(key).cast("string").alias("key"), "_page", F.col("low").cast("string").alias("low"), F.col("high").cast("string").alias("high"), F.concat(F.lit('{"results":'), results, F.lit(',"paging":'), paging, F.lit("}")).alias("value"))

    def write(batches):
        import pyarrow as pa

        files, base = _fs(path)
        for batch in batches:
            names = []
            for k, n, text in zip(batch.column("key").to_pylist(), batch.column("_page").to_pylist(), batch.column("value").to_pylist()):
                files.create_dir(f"{base}/{k}", recursive=True)
                with files.open_output_stream(f"{base}/{k}/{n:06d}.json") as f:
                    f.write(text.encode())
                names.append(f"{k}/{n:06d}.json")
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("_page"), batch.column("low"), batch.column("high"), pa.array(names)], ["key", "page", "low", "high", "file"])

    page.mapInArrow(write, "key string, page int, low string, high string, file string").write.mode("overwrite").parquet(f"{path}/pages")


def pages(spark: SparkSession, path: str, schema, key: str, at: str, keys: list | None = None, since: str | None = None, until: str | None = None) -> DataFrame:
    """Landed pages' rows of the given keys from `since` on and before `until` (None: all).

    The list of pages is a table, so the conditions are pushed to its scan, and only pages that can match are opened; each
    is a row of its own there, so a key of many pages is read by many tasks.
    """
    listed = spark.read.parquet(f"{path}/pages")
    for asked in ([F.col("key").isin(*map(str, keys))] if keys is not None else []) + ([F.col("high") >= since] if since else []) + ([F.col("low") < until] if until else []):
        listed = listed.filter(asked)

    def read(batches):
        for batch in batches:
            for file in batch.column("file").to_pylist():
                yield _batch(_load(f"{path}/{file}")["results"], schema)

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = listed.select("file").repartition(n, "file").mapInArrow(read, schema)
    for asked in ([F.col(key).cast("string").isin(*map(str, keys))] if keys is not None else []) + ([F.col(at) >= F.lit(since).cast(schema[at].dataType)] if since else []) + ([F.col(at) < F.lit(until).cast(schema[at].dataType)] if until else []):
        rows = rows.filter(asked)
    return rows


class _Messages(InputPartition):
    def __init__(self, account: str, file: str):
        super().__init__((account, file))
        self.account, self.file = account, file


class MailboxReader(DataSourceStreamReader):
    def __init__(self, options: dict, schema):
        self.path, self.schema = options["path"], schema

    def initialOffset(self):
        return {}

    def latestOffset(self):
        """How many batches each account has: a listing of names, nothing is opened."""
        from pyarrow import fs

        files, base = _fs(self.path)
        offset: dict[str, int] = {}
        for x in files.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True)):
            if x.is_file and x.path.endswith(".json") and len(names := x.path.removeprefix(base).strip("/").split("/")) == 2:
                account, name = names
                offset[account] = max(offset.get(account, 0), int(name.removesuffix(".json")) + 1)
        return offset

    def partitions(self, start, end):
        """A task for each part of what has come: of a batch only its list is opened."""
        lists = [(a, f"{a}/{k:08d}.json") for a, n in sorted(end.items()) for k in range(start.get(a, 0), n)]
        return [_Messages(a, part) for a, name in lists for part in _load(f"{self.path}/{name}")["parts"]]

    def read(self, partition):
        yield _batch([r | {"account": partition.account} for r in _load(f"{self.path}/{partition.file}")], self.schema)

    def commit(self, end):
        pass


class MailboxSource(DataSource):
    """format("tidemark_mailbox") with path and a schema: a stream of the messages that have landed in accounts' folders."""

    @classmethod
    def name(cls):
        return "tidemark_mailbox"

    def streamReader(self, schema):
        return MailboxReader(dict(self.options), schema)


def mailbox(spark: SparkSession, path: str, schema) -> DataFrame:
    spark.dataSource.register(MailboxSource)
    return spark.readStream.format("tidemark_mailbox").schema(schema).option("path", path).load()


def land_messages(df: DataFrame, path: str, account: str, number: int) -> None:
    """df's messages as batch `number` of each account's folder: parts of PART_BYTES or little more, and, once all are written, their list, which makes the batch be there.

    An account, however large, is dealt to several tasks, and a task holds a few parts at a time.
    """
    files, base = _fs(path)
    files.create_dir(base, recursive=True)
    cells = F.to_json(F.struct(*df.columns))
    rows = df.select(F.col(account).cast("string").alias("key"), cells.alias("row"))
    rows = rows.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key", F.pmod(F.xxhash64("row"), F.lit(SHARES)))

    def write(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        out, to = _fs(path)
        task, n, held = TaskContext.get().partitionId(), 0, {}

        def flush(k: str) -> pa.RecordBatch:
            nonlocal n
            name = f"{k}/{number:08d}.parts/{task:06d}-{n:06d}.json"
            n += 1
            out.create_dir(f"{to}/{k}/{number:08d}.parts", recursive=True)
            with out.open_output_stream(f"{to}/{name}") as f:
                f.write(("[" + ",".join(held.pop(k)[0]) + "]").encode())
            return pa.RecordBatch.from_arrays([pa.array([k]), pa.array([name])], ["key", "part"])

        for batch in batches:
            for k, text in zip(batch.column("key").to_pylist(), batch.column("row").to_pylist()):
                texts, size = held.get(k, ([], 0))
                texts.append(text)
                held[k] = (texts, size + len(text))
                if held[k][1] >= PART_BYTES:
                    yield flush(k)
            while sum(size for _, size in held.values()) > 4 * PART_BYTES:
                yield flush(max(held, key=lambda k: held[k][1]))
        for k in list(held):
            yield flush(k)

    def lists(batches):
        out, to = _fs(path)
        for batch in batches:
            for k, parts in zip(batch.column("key").to_pylist(), batch.column("parts").to_pylist()):
                with out.open_output_stream(f"{to}/{k}/{number:08d}.json") as f:
                    f.write(json.dumps({"parts": parts}).encode())
            yield batch

    parts = rows.mapInArrow(write, "key string, part string").groupBy("key").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    parts.mapInArrow(lists, "key string, parts array<string>").write.format("noop").mode("overwrite").save()
