"""Pages, mailboxes and keyed state over batches that come one after another."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import joins
from tidemark.sources import io, paged
from tidemark.streaming import jobs

DEALS = "id long, owner long, amount double, closed timestamp, note string"


@pytest.fixture
def deals(spark):
    day = datetime(2024, 1, 1)
    return spark.createDataFrame([(k, k % 3 if k < 900 else 0, k / 2, day + timedelta(hours=k // 2), None if k % 7 == 0 else f'"n" {k} é') for k in range(1000)], DEALS)


def test_pages_are_chained_and_only_those_that_match_are_opened(spark, deals, tmp_path):
    path = f"file:{tmp_path}/pages"
    paged.land_pages(deals, path, "owner", "closed", "id")
    first = json.loads((tmp_path / "pages/1/000000.json").read_text())
    assert len(first["results"]) == 100 and first["paging"]["next"]["after"] == "1"
    assert json.loads((tmp_path / "pages/1/000002.json").read_text())["paging"] == {}
    assert sorted(map(tuple, paged.pages(spark, path, deals.schema, "owner", "closed").collect())) == sorted(map(tuple, deals.collect()))
    since, until = "2024-01-06 00:00:00", "2024-01-09 12:00:00"
    want = deals.filter((F.col("owner") == 1) & (F.col("closed") >= since) & (F.col("closed") < until))
    # pages that can't match are gone, and nobody misses them
    needed = spark.read.parquet(f"{path}/pages").filter("key = '1'").filter(f"high >= '{since}' and low < '{until}'")
    for f in (tmp_path / "pages").glob("*/*.json"):
        if f"{f.parent.name}/{f.name}" not in {r.file for r in needed.collect()}:
            f.unlink()
    got = paged.pages(spark, path, deals.schema, "owner", "closed", [1], since, until)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() > 0
    plan = got._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(key), IsNotNull(high), IsNotNull(low), EqualTo(key,1), GreaterThanOrEqual(high" in plan
    assert paged.pages(spark, path, deals.schema, "owner", "closed", [5]).count() == 0


MAIL = "message_id string, sender string, `to` array<string>, cc array<string>, sent timestamp, subject string, account string"


def _mails(spark, ids, account):
    return spark.createDataFrame([(i, "x", ["y"], None, datetime(2024, 1, 1), "s", account) for i in ids], MAIL)


def test_each_account_has_its_own_offset(spark, tmp_path):
    """A batch reads what is new alone, a message counts once over accounts and batches, and a rerun changes nothing."""
    box, out, marks = (f"file:{tmp_path}/{n}" for n in ("box", "edges", "marks"))
    read = []

    def run():
        query = jobs.build_edges(paged.mailbox(spark, box, _mails(spark, ["a"], "one").schema), out, marks)
        read.append(sum(int(p["numInputRows"]) for p in query.recentProgress))
        return [(r.src, r.dst, r.n) for r in jobs.edges(spark, out).collect()]

    paged.land_messages(_mails(spark, ["a", "b"], "one").union(_mails(spark, ["c"], "two")), box, "account", 0)
    assert run() == [("x", "y", 3)]
    paged.land_messages(_mails(spark, ["c", "d"], "two"), box, "account", 1)
    assert run() == [("x", "y", 4)]
    paged.land_messages(_mails(spark, ["a", "e"], "three"), box, "account", 0)
    assert run() == [("x", "y", 5)]
    assert run() == [("x", "y", 5)]
    assert read == [3, 2, 2, 0]


def test_ids_are_forgotten_with_time(spark, tmp_path):
    landing, out, marks = (f"file:{tmp_path}/{n}" for n in ("landing", "edges", "marks"))
    for day, ids in ((1, ["a", "b"]), (2, ["a", "c"]), (40, ["d"]), (41, ["a"])):
        rows = _mails(spark, ids, "one").withColumn("sent", F.lit(datetime(2024, 1, 1) + timedelta(days=day)))
        rows.coalesce(1).write.mode("append").parquet(landing)
        jobs.build_edges(jobs.landed(spark, landing, rows.schema), out, marks, at="sent", keep="10 days")
    assert [r.n for r in jobs.edges(spark, out).collect()] == [5]


def test_time_fires_timers(spark, tmp_path):
    landing, out, marks = (f"file:{tmp_path}/{n}" for n in ("landing", "prospects", "marks"))
    schema = "handle string, kind string, post string, ts timestamp"
    at = lambda h: datetime(2024, 1, 1) + timedelta(hours=h)

    def run(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
        jobs.keep_updates(jobs.warm_up_with_times(jobs.landed(spark, landing, spark.read.parquet(landing).schema), wait="2 hours", late="1 hour"), out, marks)
        return {r.handle: r for r in jobs.last_updates(spark, out, ["handle"], "retries").collect()}

    got = run(("a", "error", "", at(0)), ("a", "advance", "", at(1)), ("a", "like", "p", at(1)), ("a", "like", "p", at(0.5)), ("b", "follow", "", at(1)))
    assert (got["a"].status, got["a"].phase, got["a"].likes, got["a"].errors, got["a"].retries) == ("in_progress", 1, 1, 1, 0)
    assert got["b"].status == "pending" and got["b"].followed == at(1)
    got = run(("b", "comment", "q", at(2.5)))  # the error is due at 2; the watermark stands at 1.5
    assert got["a"].retries == 0
    got = run(("b", "comment", "q", at(3.5)), ("a", "advance", "", at(3)))
    assert got["a"].retries == 1 and got["a"].phase == 2 and got["a"].started == at(1) and got["a"].moved == at(3) and got["b"].comments == 1


def test_quotas_of_a_hot_day(spark):
    rows = spark.range(5000).select("id", F.lit("d").alias("day"), F.when(F.col("id") % 50 == 0, "note").otherwise("like").alias("kind"))
    got = jobs.within_quotas(rows, "day", "kind", "id", {"like": 75, "follow": 3})
    assert {(r.kind, r.n, r.last) for r in got.groupBy("kind").agg(F.count("id").alias("n"), F.max("id").alias("last")).collect()} == {("note", 100, 4950), ("like", 75, 76)}


def test_a_run_that_dies_is_never_the_newest(spark, tmp_path):
    path, rows = f"file:{tmp_path}/runs", spark.range(5).withColumn("v", F.lit(1))
    io.publish(rows, path, "2024-01")
    # dies after its rows, before its marker; and in the middle of its rows
    rows.withColumn("v", F.lit(2)).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/run_id=2024-02")
    with pytest.raises(Exception, match="boom"):
        io.publish(rows.withColumn("v", F.raise_error(F.lit("boom")).cast("int")), path, "2024-03")
    assert io.finished_runs(spark, path) == ["2024-01"] and io.latest_version(spark, path).first().v == 1
    io.publish(rows.withColumn("v", F.lit(4)), path, "2023-12", keep=2)
    assert io.latest_version(spark, path).first().v == 4 and io.finished_runs(spark, path) == ["2023-12", "2024-01"]
    io.publish(rows.withColumn("v", F.lit(5)), path, "2024-01", keep=1)
    assert io.latest_version(spark, path).first().v == 5 and io.finished_runs(spark, path) == ["2024-01"]


def test_sides_are_broadcast_by_rows_and_bytes(spark):
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    wide = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("t"), F.array(F.lit(1)).alias("a"))
    assert hinted(joins.small(wide)) and not hinted(joins.small(wide, size=50_000)) and not hinted(joins.small(wide, limit=99)) and hinted(joins.small(wide.filter("false")))


def test_a_large_account_lands_in_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(paged, "PART_BYTES", 2_000)
    monkeypatch.setattr(paged, "SHARES", 4)
    box, ids = f"file:{tmp_path}/box", [f"m{k}" for k in range(300)]
    mails = _mails(spark, ids, "one")
    paged.land_messages(mails, box, "account", 0)
    parts = list((tmp_path / "box/one/00000000.parts").glob("*.json"))
    assert len(parts) > 10 and max(p.stat().st_size for p in parts) < 2_500
    (tmp_path / "box/one/00000001.parts").mkdir()  # a batch without a list isn't there yet
    (tmp_path / "box/one/00000001.parts/000000-000000.json").write_text("[")
    reader = paged.MailboxReader({"path": box}, mails.schema)
    assert reader.latestOffset() == {"one": 1}
    tasks = reader.partitions({}, {"one": 1})
    assert len(tasks) == len(parts) and sorted(x for t in tasks for b in reader.read(t) for x in b.column("message_id").to_pylist()) == sorted(ids)


def test_pages_of_a_large_key_are_dealt_in_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(paged, "RANGE_ROWS", 100)
    path = f"file:{tmp_path}/pages"
    rows = spark.range(2_345).select("id", F.when(F.col("id") % 9 == 0, "small").otherwise("large").alias("owner"), (F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 7)).alias("at"))
    paged.land_pages(rows, path, "owner", "at", "id", rows=50)
    for owner in ("large", "small"):
        want = [r.id for r in rows.filter(F.col("owner") == owner).orderBy("at", "id").collect()]
        pages = [json.loads(p.read_text()) for p in sorted((tmp_path / "pages" / owner).glob("*.json"))]
        assert [r["id"] for p in pages for r in p["results"]] == want and {len(p["results"]) for p in pages[:-1]} == {50}
        assert [p["paging"].get("next", {}).get("after") for p in pages] == [*map(str, range(1, len(pages))), None]
    assert paged.pages(spark, path, rows.schema, "owner", "at").count() == 2_345
