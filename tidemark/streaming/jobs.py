"""Incremental jobs. Checkpoints take the place of lists of what has been done; a rerun goes on where the last one ended."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

# Phases of a warm-up, and actions of a day.
PHASES = 7
QUOTAS = {"follow": 25, "like": 75, "comment": 12}
STATE = "phase int, liked array<string>, commented array<string>, errors int"


def landed(spark: SparkSession, path: str, schema, files: int = 100) -> DataFrame:
    """A stream of the Parquet files that land in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def on_disk(spark: SparkSession):
    """While streams start, their state is kept on disk with changes in the checkpoint: it may outgrow memory, and a batch costs what it changes."""
    keys = {"spark.sql.streaming.stateStore.providerClass": ROCKS, "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _run(df: DataFrame, checkpoint: str, batch, mode: str = "append"):
    with on_disk(df.sparkSession):
        query = df.writeStream.outputMode(mode).foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    return query


def build_edges(mails: DataFrame, folder: str, checkpoint: str, at: str | None = None, keep: str = "30 days"):
    """Adds the mails that have come to a folder of partial edges, by batch: a batch that is repeated replaces its own part.

    A message counts once, in the first batch that has it: its id stays in a keyed state store, which a batch asks for its
    own ids alone, however many there have been. With a time column, ids are forgotten `keep` after the latest time seen.
    """
    from ..operators.graph import knows

    once = mails.dropDuplicates(["message_id"]) if at is None else mails.withWatermark(at, keep).dropDuplicatesWithinWatermark(["message_id"])

    def batch(df, n):
        knows(df).drop("last_subject").write.mode("overwrite").parquet(f"{folder}/batch={n}")

    return _run(once, checkpoint, batch)


def edges(spark: SparkSession, folder: str) -> DataFrame:
    """src, dst, n, first, last: all parts of the edges so far."""
    parts = spark.read.option("basePath", folder).parquet(f"{folder}/batch=*")
    return parts.groupBy("src", "dst").agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"))


def watermarks(rows: DataFrame, account: str, at: str) -> DataFrame:
    """account, last_sync: the latest time that each account has sent."""
    return rows.groupBy(account).agg(F.max(at).alias("last_sync"))


def new_since(rows: DataFrame, marks: DataFrame, account: str, at: str) -> DataFrame:
    """rows after their account's last_sync, and all of accounts without one."""
    m = marks.select(F.col(account).alias("_a"), "last_sync")
    return rows.join(m, rows[account] == F.col("_a"), "left").filter(F.col("last_sync").isNull() | (F.col(at) > F.col("last_sync"))).drop("_a", "last_sync")


def windowed_counts(events: DataFrame, at: str, by: str, width: str, late: str) -> DataFrame:
    """Counts by event-time windows of `width`; what comes later than `late` isn't counted."""
    return events.withWatermark(at, late).groupBy(F.window(at, width).alias("w"), by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), by, "n")


def keep_updates(rows: DataFrame, folder: str, checkpoint: str):
    """Runs a stateful stream over what has landed; each batch leaves its updates in a part of the folder, which a repeated batch replaces."""

    def batch(df, n):
        df.write.mode("overwrite").parquet(f"{folder}/batch={n}")

    return _run(rows, checkpoint, batch, "update")


def last_updates(spark: SparkSession, folder: str, keys: list[str], *then: str) -> DataFrame:
    """The last update of each key: of the last batch, and within it, where a key may have several, the greatest by `then`."""
    rows = spark.read.option("basePath", folder).parquet(f"{folder}/batch=*")
    cells = [c for c in rows.columns if c not in (*keys, "batch")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*cells), F.struct("batch", *then)).alias("_x")).select(*keys, *(F.col(f"_x.{c}").alias(c) for c in cells))


def fold(events: pd.DataFrame, state: tuple[int, list[str], list[str], int]) -> tuple[int, list[str], list[str], int]:
    """A prospect's state after its events: `advance` moves on as far as the last phase; a post is liked, and commented on, once; errors count as retries."""
    phase, liked, commented, errors = state
    liked, commented = list(liked), list(commented)
    for kind, post in zip(events["kind"], events["post"]):
        if kind == "advance":
            phase = min(PHASES, phase + 1)
        elif kind == "like" and post not in liked:
            liked.append(post)
        elif kind == "comment" and post not in commented:
            commented.append(post)
        elif kind == "error":
            errors += 1
    return phase, liked, commented, errors


def warm_up(events: DataFrame) -> DataFrame:
    """handle, status and counts after each batch of events (handle, kind, post, ord), whose state is kept from batch to batch."""

    def step(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.get if state.exists else (0, [], [], 0)
        now = fold(pd.concat(list(batches)).sort_values("ord"), now)
        state.update(now)
        phase, liked, commented, errors = now
        yield pd.DataFrame([(*key, "in_progress" if phase else "pending", phase, len(liked), len(commented), errors)], columns=["handle", "status", "phase", "likes", "comments", "errors"])

    return events.groupBy("handle").applyInPandasWithState(step, "handle string, status string, phase int, likes int, comments int, errors int", STATE, "update", GroupStateTimeout.NoTimeout)


PLAN = "handle string, status string, phase int, started timestamp, moved timestamp, followed timestamp, likes long, comments long, errors int, retries int"


class WarmUp(StatefulProcessor):
    """A prospect's state: phase and times of phases, who was followed when, posts liked and commented on with their times, errors, and retries that came due.

    Events (handle, kind, post, ts) may come in any order within the watermark: times are least ones, counts are of
    distinct posts, so the state doesn't depend on the order. An error comes due again `wait` later by event time. A batch
    is added up before the state is asked: for its own posts, each once. Its errors' times are appended to a list, and a
    single timer stands at the earliest; when it fires, all that have come due by then are counted.
    """

    def __init__(self, wait_ms: int):
        self.wait_ms = wait_ms

    def init(self, handle):
        self.handle = handle
        self.plan = handle.getValueState("plan", "phase int, started timestamp, moved timestamp, followed timestamp, likes long, comments long, errors int, retries int, timer long")
        self.liked = handle.getMapState("liked", "post string", "at timestamp")
        self.commented = handle.getMapState("commented", "post string", "at timestamp")
        self.due = handle.getListState("due", "at array<long>")

    def _now(self):
        now = list(self.plan.get()) if self.plan.exists() else [0, None, None, None, 0, 0, 0, 0, None]
        return [None if x is not None and pd.isna(x) else x for x in now]

    def _row(self, key, now):
        row = (*key, "in_progress" if now[0] else "pending", *now[:-1])
        columns = [c.split()[0] for c in PLAN.split(", ")]
        frame = pd.DataFrame([row], columns=columns)
        return frame.astype({c: "datetime64[ns]" for c in ("started", "moved", "followed")})

    @staticmethod
    def _add(posts, found: dict) -> int:
        """Keeps the least time of each post; how many are new."""
        new = 0
        for post, at in found.items():
            before = posts.getValue((post,))[0] if posts.containsKey((post,)) else None
            new += before is None
            if before is None or at < before:
                posts.updateValue((post,), (at,))
        return new

    def _wake(self, now, at: int):
        """The only timer, at the earliest time that an error comes due."""
        if now[8] is not None and now[8] <= at:
            return
        if now[8] is not None:
            self.handle.deleteTimer(now[8])
        self.handle.registerTimer(at)
        now[8] = at

    def handleInputRows(self, key, rows, timerValues):
        now = self._now()
        least = lambda a, b: b if a is None else min(a, b)
        posts: dict[str, dict] = {"like": {}, "comment": {}}
        for frame in rows:
            for kind, some in frame.groupby("kind"):
                first, last = some["ts"].min().to_pydatetime(), some["ts"].max().to_pydatetime()
                if kind == "advance":
                    now[0] = min(PHASES, now[0] + len(some))
                    now[1] = least(now[1], first)
                    now[2] = last if now[2] is None else max(now[2], last)
                elif kind == "follow":
                    now[3] = least(now[3], first)
                elif kind in posts:
                    for post, at in some.groupby("post", dropna=False)["ts"].min().items():
                        post = None if pd.isna(post) else post
                        posts[kind][post] = least(posts[kind].get(post), at.to_pydatetime())
                elif kind == "error":
                    now[6] += len(some)
                    times = (some["ts"].astype("datetime64[ms]").astype("int64") + self.wait_ms).unique().tolist()
                    self.due.appendValue((times,))
                    self._wake(now, min(times))
        now[4] += self._add(self.liked, posts["like"])
        now[5] += self._add(self.commented, posts["comment"])
        self.plan.update(tuple(now))
        yield self._row(key, now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now, fired = self._now(), expiredTimerInfo.getExpiryTimeInMs()
        by = max(fired, timerValues.getCurrentWatermarkInMs() - 1)  # timers before the watermark fire
        times = {t for chunk in self.due.get() for t in chunk[0]}
        later = [t for t in times if t > by]
        now[7] += len(times) - len(later)
        now[8] = None
        self.due.clear()
        if later:
            self.due.appendValue((later,))
            self._wake(now, min(later))
        self.plan.update(tuple(now))
        yield self._row(key, now)

    def close(self):
        pass


def warm_up_with_times(events: DataFrame, wait: str = "2 hours", late: str = "1 hour") -> DataFrame:
    """PLAN after each batch of events (handle, kind, post, ts) and each retry that comes due by event time; of errors of one millisecond one comes due."""
    ms = int(pd.Timedelta(wait).total_seconds() * 1000)
    rows = events.withWatermark("ts", late).groupBy("handle")
    return rows.transformWithStateInPandas(statefulProcessor=WarmUp(ms), outputStructType=PLAN, outputMode="Update", timeMode="EventTime")


def within_quotas(actions: DataFrame, day: str, kind: str, order: str, quotas: dict[str, int] = QUOTAS) -> DataFrame:
    """The first actions of each kind and day by order, as many as its quota lets; kinds without one all stay."""
    most = F.coalesce(*(F.when(F.col(kind) == k, F.lit(n)) for k, n in quotas.items()), F.lit((1 << 31) - 1))
    place = F.row_number().over(Window.partitionBy(day, kind).orderBy(order))
    bounded = F.col(kind).isin(*quotas)
    # a literal bound first: each task passes on so many rows of a day and kind at most
    first = actions.filter(bounded).withColumn("_n", place).filter(F.col("_n") <= max(quotas.values())).filter(F.col("_n") <= most).drop("_n")
    return first.unionByName(actions.filter(~F.coalesce(bounded, F.lit(False))))
