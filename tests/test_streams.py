"""Streams that stop and go on: results after a restart equal one batch run."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from vialflow.operators import mining
from vialflow.session import scratch_path
from vialflow.streaming import streams as S

SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double"


@pytest.fixture()
def landing(spark):
    """A folder and a way to land another part file in it."""
    folder = scratch_path(spark, "landing")
    rng, start, rows = random.Random(5), datetime(2024, 1, 1), []

    def land(n):
        part = [(len(rows) + i, start + timedelta(minutes=rng.randrange(5000)), rng.choice([1] * 8 + [2, 3]), rng.choice("ab"),
                 rng.choice([None, float("nan"), round(rng.gauss(0, 10), 1)])) for i in range(n)]
        rows.extend(part)
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")
        return rows
    return folder, land


def test_updates_go_on_after_a_restart(spark, landing):
    folder, land = landing
    out = scratch_path(spark, "restart")
    for n in (300, 5, 40):
        rows = land(n)
        stream = S.latest_per_source(S.table_stream(spark, folder, "events"), "user_id", "ts", "event_type", "event_id")
        got = {r["user_id"]: tuple(r)[1:] for r in S.run_updates(stream, ["user_id"], "latest", out).collect()}
        want = {}
        for u in {r[2] for r in rows}:
            mine = [r for r in rows if r[2] == u]
            last = max(mine, key=lambda r: (r[1], r[0]))
            want[u] = (last[1], last[3], len(mine))
        assert got == want
    versions = spark.read.parquet(out).groupBy("epoch").count().where("epoch >= 0").collect()
    assert len(versions) == 3  # one version per run, none written again


def test_alerts_go_on_after_a_restart(spark, landing):
    folder, land = landing
    out = scratch_path(spark, "restart-best")
    want, best, seen = set(), {}, 0
    for n in (400, 3, 60):
        rows = land(n)
        for e, _, u, _, v in sorted(rows[seen:], key=lambda r: (r[1], r[0])):
            if v is not None and v == v and (u not in best or v > best[u]):
                want.add((u, e, v, best.get(u)))
                best[u] = v
        seen = len(rows)
        got = S.best_alerts(S.table_stream(spark, folder, "events"), out).collect()
        assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_json_kinds_decide_the_type(spark):
    rows = [(1, "t", '{"k": 5}'), (2, "t", '{"k": "5"}'), (3, "t", '{"k": null}'), (4, "t", '{"k": 5.5}'), (5, "t", "[5]"), (6, "t", None),
            (7, "t", "{"), (8, "t", '{"k": 1, "z": 2, "a": 0}'), (9, "t", "{}"), (10, "u", "{}"), (11, None, "{}"), (12, "s", '{"a b": "x"}'),
            (13, "s", '{"a b": true}')]
    df = spark.createDataFrame(rows, "id int, tool string, args string")
    got = {r["id"]: r["error"] or r["call"] for r in mining.route_calls(df, "id", "tool", "args", {
        "t": {"k": "number"}, "s": {"a b": "string"}}).collect()}
    assert got == {1: "k=5", 2: "wrong type", 3: "wrong type", 4: "k=5.5", 5: "bad json", 6: "bad json", 7: "bad json",
                   8: "unexpected: a,z", 9: "missing: k", 10: "unknown tool", 11: "unknown tool", 12: "a b=x", 13: "wrong type"}
    turns = mining.collect_results(mining.route_calls(df, "id", "tool", "args", {"t": {"k": "number"}}).withColumn(
        "turn", F.col("id") % 2), ["turn"], ["id"]).orderBy("turn", "place").collect()
    assert [r["place"] for r in turns] == [1, 2, 3, 4, 5, 6, 1, 2, 3, 4, 5, 6, 7] and turns[0]["content"] == "error: wrong type"
