"""The latest-row state of the streams against the batch models."""

import json
import os
import random

import pytest

from riskmesh.operators import silver
from riskmesh.operators.dedup import dedup_latest, latest_by_aggregate
from riskmesh.sources.bronze import read_bronze
from riskmesh.streaming.micro_loads import land, latest_load, update_latest
from tests.conftest import rows

AS_OF = "2026-12-31"
LINES = "session_id", "player_id", "ip", "device", "timestamp"


def write_lines(folder, name, records):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("".join(json.dumps(dict(zip(LINES, r))) + "\n" for r in records))


def test_aggregate_equals_window_dedup(spark):
    rng = random.Random(4)
    data = [(f"k{rng.randrange(40)}", rng.choice([None, 1, 2, 3]), rng.choice([None, "2026-01-01", "2026-01-02"]), rng.choice([None, "x", "y"]), rng.choice([None, 1, 2]))
            for _ in range(600)]
    df = spark.createDataFrame(data, "k string, at int, dt string, v string, n int") \
        .selectExpr("k", "timestamp_seconds(at) as at", "cast(dt as date) as dt", "v", "cast(n as decimal(38,9)) as n")
    want = rows(dedup_latest(df, "k", ["at", "dt"]))
    got = latest_by_aggregate(df, "k", ["at", "dt"], values_of="dt")
    assert rows(got.drop("all_values")) == want
    days = {(r.k, r.dt) for r in df.collect() if r.dt}
    assert {(r.k, d) for r in got.collect() for d in r.all_values} == days


def test_two_runs_equal_the_batch_model_without_reading_bronze_again(spark, workdir):
    rng = random.Random(5)
    landing, progress, target = (os.path.join(workdir, x) for x in ("landing", "progress", "silver"))

    def some(n):
        return [(f"s{rng.randrange(60)}", rng.choice(["p1", "p2", "p3"]), rng.choice(["a", None]), " WEB ", f"2026-01-{rng.randrange(1, 9):02d} {rng.randrange(24):02d}:30:00") for _ in range(n)]

    first, second = some(150), some(90)       # newer, late and repeated versions; keys move between days
    write_lines(landing, "a.jsonl", first)
    assert latest_load(spark, f"{landing}/*.jsonl", "sessions", target, progress, "jsonl", as_of=AS_OF) == 150
    bronze = read_bronze(spark, f"{progress}/bronze", "sessions", "1900-01-01", "9999-12-31")
    assert rows(spark.read.parquet(target), *LINES[:4], "session_at") == rows(silver.slv_sessions(bronze, as_of=AS_OF), *LINES[:4], "session_at")
    write_lines(landing, "b.jsonl", second)
    assert land(spark, f"{landing}/*.jsonl", "sessions", f"{progress}/bronze", f"{progress}/checkpoint", "jsonl") == 90
    assert update_latest(spark, f"{progress}/bronze", "sessions", target, f"{progress}/latest", as_of=AS_OF) == 90   # the new bronze rows alone
    bronze = read_bronze(spark, f"{progress}/bronze", "sessions", "1900-01-01", "9999-12-31")
    got = spark.read.parquet(target)
    assert bronze.count() == 240 and got.count() == got.select("session_id").distinct().count()
    assert rows(got, *LINES[:4], "session_at") == rows(silver.slv_sessions(bronze, as_of=AS_OF), *LINES[:4], "session_at")
    before = rows(got)
    assert latest_load(spark, f"{landing}/*.jsonl", "sessions", target, progress, "jsonl", as_of=AS_OF) == 0
    assert rows(spark.read.parquet(target)) == before


@pytest.mark.parametrize("kind", ["json", "csv"])
def test_landed_rows_are_counted_not_lines_or_files(spark, workdir, kind):
    landing = os.path.join(workdir, "landing")
    os.makedirs(landing)
    with open(f"{landing}/players.{kind}", "w") as f:
        if kind == "json":
            json.dump([{"player_id": f"p{i}", "email": "a@b.c", "city": "x", "created_at": "2026-01-01"} for i in range(5)], f, indent=1)
        else:
            f.write("player_id,email,city,created_at\n" + "".join(f'p{i},a@b.c,"two\nlines",2026-01-01\n' for i in range(5)))
    assert land(spark, f"{landing}/*", "players", f"{workdir}/bronze", f"{workdir}/checkpoint", kind) == 5
    assert spark.read.parquet(f"{workdir}/bronze").count() == 5
