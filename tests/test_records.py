"""Landing text cut into records by many tasks, against readers of whole files."""

import contextlib
import csv
import io
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from riskmesh.sources import ingest
from riskmesh.sources.records import JSON_LEAD, RecordError, cut_records
from riskmesh.specs import FEEDS

SPEC = FEEDS["players"]


@contextlib.contextmanager
def splits(spark, size):
    conf = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    old = {k: spark.conf.get(k) for k in conf if spark.conf.get(k, None) is not None}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in conf:
            spark.conf.set(k, old[k]) if k in old else spark.conf.unset(k)


def field(rng):
    return "".join(rng.choice(['a', 'é', '"', ",", "\n", "}", "{", "[", "]", "\\", " ", "x1", ":", "\r\n"]) for _ in range(rng.randrange(0, 12)))


def players(rng, n, long=0):
    return [{"player_id": f"p{i}", "email": field(rng), "city": field(rng) * (long if i % 11 == 0 else 1), "created_at": "2026-01-20"} for i in range(n)]


def as_csv(records, end="\n"):
    out = io.StringIO()
    w = csv.writer(out, lineterminator=end)
    w.writerow(SPEC.columns)
    w.writerows([[r[c] for c in SPEC.columns] for r in records])
    return out.getvalue()


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", newline="") as f:
        f.write(text)
    return os.path.join(folder, name)


def got(landing):
    return sorted(tuple(r) for r in landing.df.select(*[F.coalesce(F.col(c), F.lit("<null>")).alias(c) for c in SPEC.columns]).collect())


@pytest.mark.parametrize("size,end", [(200, "\n"), (250, "\r\n"), (1 << 27, "\n")])
def test_csv_equals_the_multi_line_reader(spark, workdir, size, end):
    rng = random.Random(size)
    records = players(rng, 45, long=20)
    path = put(workdir, "a.csv", as_csv(records, end))
    want = sorted(tuple(r[c] for c in SPEC.columns) for r in records)
    with splits(spark, size):
        cut = ingest.read_csv(spark, path, SPEC)
        assert got(cut) == want
        if size < 1000:
            blocks = spark.read.parquet(f"{cut.scratch}/blocks")
            assert blocks.count() > 4 and spark.read.text(path).rdd.getNumPartitions() > 4
    if end == "\n":    # Spark's reader turns line ends inside quotes into newlines where lines end with CR LF
        assert got(ingest.read_csv(spark, path, SPEC, multi_line=True)) == want


@pytest.mark.parametrize("size,indent", [(200, None), (250, 1), (1 << 27, None)])
def test_json_arrays_equal_json(spark, workdir, size, indent):
    rng = random.Random(size)
    records = players(rng, 40, long=20)
    for i, r in enumerate(records):
        r["email"] = rng.choice([r["email"], None, {"k": [1, {"z": field(rng)}]}, [field(rng), {"a": {}}], 1.5, True])
    path = put(workdir, "a.json", json.dumps(records, indent=indent, ensure_ascii=False))
    with splits(spark, size):
        cut, scratch = cut_records(spark, path, "json")
        texts = [r.value for r in cut.select(F.regexp_replace("text", JSON_LEAD, "").alias("value")).collect()]
        if size < 1000:
            assert spark.read.parquet(f"{scratch}/blocks").count() > 4
    assert sorted(map(json.dumps, map(json.loads, texts))) == sorted(map(json.dumps, records))


def test_several_files_headers_and_leftovers(spark, workdir):
    rng = random.Random(1)
    one, two = players(rng, 30), players(rng, 40)
    folder = os.path.join(workdir, "csv")
    put(folder, "a.csv", as_csv(one))
    put(folder, "b.csv", as_csv(two) + "\n\n")
    put(folder, "empty.csv", "")
    with splits(spark, 200):
        assert got(ingest.read_csv(spark, folder, SPEC)) == sorted(tuple(r[c] for c in SPEC.columns) for r in one + two)
        put(folder, "c.csv", "player_id,city,email,created_at\n")
        with pytest.raises(ValueError, match="different headers"):
            ingest.read_csv(spark, folder, SPEC)
        bad = put(workdir, "bad.csv", 'player_id,email,city,created_at\np1,a,5" pipe,2026-01-20\np2,a,b,2026-01-20\n')
        with pytest.raises(Exception, match="quote inside a field"):
            ingest.read_csv(spark, bad, SPEC).df.collect()
        for text in ('[{"player_id": "p"}', '[{"player_id": "p"}, {"player_id": "q"', '[{"player_id": "p"}, {"player_id": "q]'):
            with pytest.raises(RecordError, match="unfinished JSON array"):
                cut_records(spark, put(workdir, "cut.json", text), "json")
        for text in ("[]", "[ ]\n", ""):
            assert cut_records(spark, put(workdir, "none.json", text), "json")[0].count() == 0


def test_ingest_leaves_no_records_behind(spark, workdir):
    from riskmesh.session import checkpoint_dir
    before = set(os.listdir(checkpoint_dir(spark)))
    path = put(workdir, "a.json", json.dumps([{"player_id": "p", "email": "e", "city": "c", "created_at": "2026-01-20"}]))
    assert ingest.ingest(spark, "players", path, os.path.join(workdir, "out"), "json").rows_written == 1
    assert {x for x in set(os.listdir(checkpoint_dir(spark))) - before if x.startswith("riskmesh-records")} == set()


def test_a_stream_reads_arrays_of_any_layout(spark, workdir):
    from riskmesh.streaming.micro_loads import land
    rng = random.Random(7)
    records = players(rng, 25)
    put(f"{workdir}/landing", "a.json", json.dumps(records[:10], indent=2))
    put(f"{workdir}/landing", "b.json", json.dumps(records[10:]))
    put(f"{workdir}/landing", "c.json", "[]")
    assert land(spark, f"{workdir}/landing", "players", f"{workdir}/bronze", f"{workdir}/progress", "json") == 25
    back = spark.read.parquet(f"{workdir}/bronze").select(*SPEC.columns).collect()
    assert sorted(map(tuple, back)) == sorted(tuple(r[c] for c in SPEC.columns) for r in records)
