"""Scans and sinks. Schemas are given, not inferred, where data are large."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import name_parts, null_if_sentinel, parse_list, us_phone
from ..operators.joins import small

FORMATS = {"csv": ",", "tsv": "\t", "txt": "\t"}


def load(spark: SparkSession, path: str, schema=None, encoding: str = "UTF-8", kind: str | None = None) -> DataFrame:
    """A table by its ending: csv, tsv, json or parquet; anything else is an error. Without a schema all csv columns are text."""
    kind = kind or path.rstrip("/").rpartition(".")[2].lower()
    reader = spark.read.schema(schema) if schema else spark.read
    if kind in FORMATS:
        return reader.option("header", True).option("sep", FORMATS[kind]).option("encoding", encoding).option("multiLine", True).option("escape", '"').csv(path)
    if kind in ("json", "jsonl"):
        return reader.option("multiLine", kind == "json").json(path)
    if kind == "parquet":
        return reader.parquet(path)
    raise ValueError(f"{path}: no reader for .{kind}")


def load_many(spark: SparkSession, paths: list[str], schema) -> DataFrame:
    """Rows of several csv files, each once, with source_file; files that can't be read are passed over."""
    reader = spark.read.schema(schema).option("header", True).option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
    return reader.csv(sorted(set(paths))).withColumn("source_file", F.col("_metadata.file_name"))


def has_columns(df: DataFrame, required: list[str]) -> bool:
    """Whether a table has the columns, whatever their case and spaces around them."""
    return {c.strip().lower() for c in required} <= {c.strip().lower() for c in df.columns}


def mapped(df: DataFrame, mapping: dict[str, str | None], targets: dict[str, tuple[str, object]]) -> DataFrame:
    """Target fields {name: (type, default)} from a mapping {source column: target}: coerced, defaults where a cell isn't of the type."""
    source = {t: s for s, t in mapping.items() if t and s in df.columns}
    return df.select(*(F.coalesce(null_if_sentinel(F.col(source[t]).cast("string")).try_cast(kind), F.lit(default).cast(kind)).alias(t) if t in source else F.lit(default).cast(kind).alias(t) for t, (kind, default) in targets.items()))


def templates(spark: SparkSession, path: str) -> DataFrame:
    """file, meta (map), subject, body of text files that may begin with a block of `key: value` lines between lines of ---."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.col("value"))
    block = F.regexp_extract("value", r"(?s)\A---\n(.*?)\n---\s*\n", 1)
    pairs = F.filter(F.transform(F.split(block, "\n"), lambda x: F.split(x, r"\s*:\s*", 2)), lambda p: (F.size(p) == 2) & (F.trim(p[0]) != "") & ~p[0].startswith("#"))
    meta = F.map_from_entries(F.transform(pairs, lambda p: F.struct(F.trim(p[0]), F.nullif(F.regexp_replace(F.trim(p[1]), r'^"(.*)"$', "$1"), F.lit("null")))))
    rest = F.regexp_replace("value", r"(?s)\A---\n.*?\n---\s*\n", "")
    subject = F.regexp_extract(rest, r"(?m)^Subject:\s*(.*)$", 1)
    return raw.select("file", meta.alias("meta"), subject.alias("subject"), F.regexp_replace(F.regexp_replace(rest, r"(?m)^Subject:.*\n?", ""), r"\A\s+|\s+\z", "").alias("body"))


def save_csv(df: DataFrame, path: str) -> None:
    """Overwrites a folder of csv files; arrays and maps as JSON."""
    flat = [F.to_json(c).alias(c) if t.startswith(("array", "map", "struct")) else F.col(c) for c, t in df.dtypes]
    df.select(*flat).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def split_rejects(df: DataFrame, invalid: Column) -> tuple[DataFrame, DataFrame]:
    """(rows to keep, rows for a side file)"""
    bad = F.coalesce(invalid, F.lit(False))
    return df.filter(~bad), df.filter(bad)


def crm_contacts(leads: DataFrame) -> DataFrame:
    """Contacts for a CRM import: those with an address, names split, first phone in US form, lists joined by ;."""
    first, last = name_parts(F.col("contact_name"))
    text = lambda c: F.coalesce(null_if_sentinel(F.col(c)), F.lit(""))
    verified = F.when(F.col("email_verified").isin("true", "valid", "accept_all", "manual"), "true").when(F.col("email_verified").isNotNull(), "false").otherwise("")
    return leads.filter(F.contains(text("primary_email"), F.lit("@"))).select(
        text("primary_email").alias("email"), first.alias("firstname"), last.alias("lastname"), text("page_name").alias("company"), text("contact_position").alias("jobtitle"), text("website_url").alias("website"),
        F.coalesce(us_phone(F.get(parse_list(F.col("phones")), F.lit(0))), F.lit("")).alias("phone"), F.array_join(parse_list(F.col("instagram_handles")), ";").alias("instagram_handles"), F.coalesce(F.col("ad_count").try_cast("int"), F.lit(0)).alias("fb_ad_count"), verified.alias("email_verified"),
    )


def message_contacts(leads: DataFrame, blocked: DataFrame) -> DataFrame:
    """page_name, name, phone, named of leads with a phone, without those whose address or digits are in blocked (value)."""
    digits = lambda c: F.regexp_replace(c, "[^0-9]", "")
    phone = F.get(parse_list(F.col("phones")), F.lit(0))
    name = F.coalesce(null_if_sentinel(F.col("contact_name")), F.lit(""))
    rows = leads.select("page_name", name.alias("name"), phone.alias("phone"), F.lower("primary_email").alias("_e"), digits(phone).alias("_d")).filter("phone is not null")
    stop = F.col("value")
    block = blocked.select(F.lower(F.trim(stop)).alias("_v")).union(blocked.select(digits(stop))).filter("_v <> ''").distinct()
    rows = rows.join(small(block), F.col("_e") == F.col("_v"), "left_anti").join(small(block), F.col("_d") == F.col("_v"), "left_anti")
    return rows.select("page_name", "name", "phone", (F.col("name") != "").alias("named"))


def newest(runs: DataFrame, keep: int) -> DataFrame:
    """The `keep` newest of runs (run_id ...): what a rotation leaves."""
    return runs.orderBy(F.desc("run_id")).limit(keep)


def not_done(rows: DataFrame, log: DataFrame, key: str, status: str = "sent") -> DataFrame:
    """rows that a log (key, status) doesn't have as done: what a resumed job works on."""
    return rows.join(small(log.filter(F.col("status") == status).select(key).distinct()), key, "left_anti")


def _files(spark: SparkSession, path: str):
    """Hadoop's file system and path, so that runs may lie wherever Spark writes."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def save_version(df: DataFrame, path: str, run_id: str) -> None:
    """Writes a run's rows beside those of other runs; a run that is repeated replaces its own. Spark's marker stands there once all is written."""
    df.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(f"{path}/run_id={run_id}")


def _names(spark: SparkSession, path: str) -> list[str]:
    files, at = _files(spark, path)
    return [x.getPath().getName() for x in files.listStatus(at)] if files.exists(at) else []


def finished_runs(spark: SparkSession, path: str) -> list[str]:
    """Ids of the runs that were written to their end, rising."""
    runs = sorted(n.removeprefix("run_id=") for n in _names(spark, path) if n.startswith("run_id="))
    return [r for r in runs if "_SUCCESS" in _names(spark, f"{path}/run_id={r}")]


def publish(df: DataFrame, path: str, run_id: str, keep: int | None = None) -> None:
    """Saves a run, then makes it the one that readers get, then, with `keep`, removes all but the newest runs.

    A pointer is a new name with the next number, made in one step after the rows are there: a run that dies before is
    never read. Of the runs that are published, `keep` stay, the last one among them; runs that died go.
    """
    spark = df.sparkSession
    save_version(df, path, run_id)
    pointers = sorted(_names(spark, f"{path}/_published"))
    number = 1 + (int(pointers[-1].split("-")[0]) if pointers else 0)
    files, at = _files(spark, f"{path}/_published/{number:09d}-{run_id}")
    files.create(at, False).close()
    if keep is None:
        return
    order = list(dict.fromkeys(p.split("-", 1)[1] for p in [*pointers, f"{number:09d}-{run_id}"][::-1]))
    for name in _names(spark, path):
        if name.startswith("run_id=") and name.removeprefix("run_id=") not in order[: max(1, keep)]:
            files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"), True)
    for p in pointers:
        if p.split("-", 1)[1] not in order[: max(1, keep)]:
            files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_published/{p}"), False)


def latest_version(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the run published last, or, where none was, of the finished run with the greatest run_id; only its files are read."""
    done = finished_runs(spark, path)
    published = [r for p in sorted(_names(spark, f"{path}/_published")) if (r := p.split("-", 1)[1]) in done]
    return spark.read.parquet(f"{path}/run_id={(published or done)[-1]}")


def save_batch(df: DataFrame, path: str, batch: int) -> None:
    """One batch of a long job: a batch that is repeated replaces its own part; what has been saved stays if the job ends."""
    df.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def saved_batches(spark: SparkSession, path: str) -> DataFrame:
    """All rows saved so far, with their batch."""
    return spark.read.option("basePath", path).parquet(f"{path}/batch=*")


def save_json(df: DataFrame, path: str) -> None:
    """Overwrites a folder with one JSON record a row; null cells are written too."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
