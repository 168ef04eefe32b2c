"""Streaming jobs over files that land one after another."""

import pandas as pd

from tidemark.streaming import jobs


def test_a_message_counts_once_over_batches(spark, tmp_path):
    schema = "message_id string, sender string, `to` array<string>, cc array<string>, sent long, subject string"
    landing, out, marks = (str(tmp_path / x) for x in ("landing", "edges", "marks"))
    for ids in (["a", "b"], ["b", "c"], ["a", "c"]):
        spark.createDataFrame([(i, "x", ["y"], None, 1, "s") for i in ids], schema).coalesce(1).write.mode("append").parquet(landing)
        mails = jobs.landed(spark, landing, spark.read.parquet(landing).schema)
        jobs.build_edges(mails, out, marks)
    assert [(r.src, r.dst, r.n) for r in jobs.edges(spark, out).collect()] == [("x", "y", 3)]


class _State:
    """A state and a handle in memory, with calls counted."""

    def __init__(self):
        self.cells, self.rows, self.timers, self.calls = {}, [], set(), 0

    getValueState = getMapState = getListState = lambda self, *_: _State()

    def __getattribute__(self, name):
        if not name.startswith("_") and name not in ("cells", "rows", "timers", "calls"):
            self.calls += 1
        return object.__getattribute__(self, name)

    def exists(self):
        return bool(self.rows)

    def get(self):
        return iter(self.rows) if isinstance(self.rows, list) else self.rows

    def update(self, row):
        self.rows = row

    def appendValue(self, row):
        self.rows.append(row)

    def clear(self):
        self.rows = []

    def containsKey(self, k):
        return k in self.cells

    def getValue(self, k):
        return self.cells[k]

    def updateValue(self, k, v):
        self.cells[k] = v

    def keys(self):
        return iter(self.cells)

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)


class _At(int):
    getExpiryTimeInMs = getCurrentWatermarkInMs = lambda self: int(self)


def test_a_batch_asks_the_state_for_its_posts_alone():
    n, at = 20_000, 1_704_067_200_000
    kinds = ["error", "like", "comment", "advance", "follow"]
    events = pd.DataFrame({"handle": "a", "kind": [kinds[k % 5] for k in range(n)], "post": [f"p{k % 40}" for k in range(n)], "ts": pd.to_datetime([at + 1000 * k for k in range(n)], unit="ms")})
    handle, job = _State(), jobs.WarmUp(3_600_000)
    job.init(handle)
    states = [x for x in vars(job).values() if isinstance(x, _State)]
    list(job.handleInputRows(("a",), iter([events[k : k + 5000] for k in range(0, n, 5000)]), _At(0)))
    assert len(handle.timers) == 1 and sum(x.calls for x in states) < 300
    first = min(handle.timers)
    assert first == at + 3_600_000
    row = list(job.handleExpiredTimer(("a",), _At(first + 10_000_000), _At(first)))[0].iloc[0]
    assert (row.errors, row.retries, row.likes, row.comments, row.phase) == (4000, 2000, 8, 8, 7) and first + 10_000_000 in handle.timers
