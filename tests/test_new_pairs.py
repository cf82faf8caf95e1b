"""Keyed state of a stream against a replay of its micro-batches."""

import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Row

from joblark.streaming.new_pairs import STATE_STORE, NewPairs, start_new_pairs

SCHEMA = "job_id string, posted_date string, crawled_at timestamp, n int, _extra string"
START = datetime(2024, 1, 1, 12)


class Stream:
    def __init__(self, spark, base):
        self.spark, self.base, self.options = spark, str(base), {}

    def put(self, rows):
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.base}/in")

    def run(self):
        pages = self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{self.base}/in")
        start_new_pairs(pages, f"{self.base}/out", f"{self.base}/checkpoint", **self.options).awaitTermination()
        return sorted(r.n for r in self.spark.read.parquet(f"{self.base}/out").collect())

    def states(self):
        state = self.spark.read.format("statestore").option("stateVarName", "kept").load(f"{self.base}/checkpoint")
        return sorted((r.key.job_id, r.key.posted_date) for r in state.collect())


@pytest.fixture
def stream(spark, tmp_path):
    return Stream(spark, tmp_path)


def at(day):
    return START + timedelta(days=day)


def replayed(batches, look_back=30):
    kept, out = {}, []
    for batch in batches:
        found = {}
        for job, date, seen, n, _ in batch:
            pair, day = (job or "", date or ""), (seen.date() - START.date()).days
            if pair not in kept or day > kept[pair] + look_back:
                out.append(n)
                found[pair] = max(day, found.get(pair, day))
        kept |= found
    return sorted(out)


def test_stream_equals_a_replay_restarts_included(stream):
    rng, batches = random.Random(1), []
    for b in range(4):
        batches.append([(rng.choice(["a", "b", "c", None]), rng.choice(["x", None]), at(rng.randint(0, 20) + 15 * b), 100 * b + i, "e") for i in range(30)])
    for batch in batches[:2]:
        stream.put(batch)
    assert stream.run() == replayed(batches[:2])
    for done in (3, 4):  # every run is a restart from the checkpoint
        stream.put(batches[done - 1])
        assert stream.run() == replayed(batches[:done])
    assert len(stream.states()) == 8


def test_late_records_are_looked_at(stream):
    stream.put([("a", "x", at(300), 1, "e")])
    stream.put([("a", "x", at(2), 2, "e"), ("b", "x", at(2), 3, "e")])
    assert stream.run() == [1, 3]


def test_state_expires(stream):
    stream.options = {"keep_ms": 500}
    stream.put([("a", "x", at(0), 1, "e"), ("b", "x", at(0), 2, "e")])
    assert stream.run() == [1, 2]
    assert len(stream.states()) == 2
    time.sleep(1)
    stream.options = {"keep_ms": 3_600_000}
    stream.put([("c", "x", at(0), 3, "e")])
    assert stream.run() == [1, 2, 3]
    assert stream.states() == [("c", "x")]
    stream.put([("a", "x", at(0), 4, "e"), ("c", "x", at(0), 5, "e")])
    assert stream.run() == [1, 2, 3, 4]


def test_the_session_keeps_its_state_store(spark, stream):
    before = spark.conf.get(STATE_STORE)
    stream.put([("a", None, at(0), 1, None)])
    assert stream.run() == [1] and spark.conf.get(STATE_STORE) == before


def test_a_pair_takes_one_read_and_one_write_of_its_state():
    calls = []

    class Kept:
        value = None

        def get(self):
            calls.append("get")
            return self.value

        def update(self, value):
            calls.append("update")
            self.value = value

    class Handle:
        def getValueState(self, name, schema, ttlDurationMs=None):
            calls.append((name, ttlDurationMs))
            return Kept()

    processor = NewPairs(30, 1000)
    processor.init(Handle())

    def kept(*days):
        return [r["_day"] for r in processor.handleInputRows(("a", "x"), iter([Row(_day=d) for d in days]), None)]

    assert [kept(5, 1), kept(35), kept(36, 35)] == [[5, 1], [], [36]]
    assert calls == [("kept", 1000), "get", "update", "get", "get", "update"]
