"""Landing -> bronze job on local files: strings kept, partitions, rows per file,
reloads, required columns, and the CSV / JSON / partition edge cases."""

import datetime as dt
import json
import os

import pyarrow.parquet as pq
import pytest

from riskmesh.sources import ingest
from riskmesh.sources.bronze import PartitionFilterRequired, read_bronze


def write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def files_under(root):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs
                  if f.endswith(".parquet"))


TX_CSV = ("transaction_id,player_id,type,amount,timestamp\n"
          "A-77,kim,bet,0.50,2025-03-09 06:15:01\n"
          "A-78,lee,withdraw,1200.00,2025-03-09 18:00:59\n")


def test_csv_to_bronze_keeps_strings_and_partitions(spark, workdir):
    src = write(os.path.join(workdir, "transactions.csv"), TX_CSV)
    dest = os.path.join(workdir, "staging", "transactions")
    rep = ingest.ingest(spark, "transactions", src, dest)
    assert (rep.rows_written, rep.partitions_written) == (2, 1)
    t = pq.read_table(files_under(dest)[0])
    assert str(t.schema.field("amount").type) == "string"
    df = read_bronze(spark, dest, "transactions", "1900-01-01", "2100-01-01")
    got = {r.transaction_id: r for r in df.collect()}
    assert got["A-77"].amount == "0.50" and got["A-77"].dt == dt.date(2025, 3, 9)
    assert json.loads(rep.to_json())["files_written"] == rep.files_written


def test_json_array_to_bronze(spark, workdir):
    src = write(os.path.join(workdir, "players.json"), json.dumps([
        {"player_id": "kim", "email": "Kim.K@Post.Example", "city": "Lyon", "created_at": "2024-11-30"},
        {"player_id": "lee", "email": "lee@post.example", "city": "Oslo", "created_at": "2024-12-01"},
    ]))
    dest = os.path.join(workdir, "players")
    rep = ingest.ingest(spark, "players", src, dest)
    assert (rep.rows_written, rep.partitions_written) == (2, 2)
    df = read_bronze(spark, dest, "players", "1900-01-01", "2100-01-01")
    assert {r.email for r in df.collect()} == {"Kim.K@Post.Example", "lee@post.example"}   # untouched


def test_rows_per_file_splits_each_partition(spark, workdir):
    src = write(os.path.join(workdir, "t.csv"), TX_CSV + "A-79,kim,deposit,31.10,2025-03-10 00:00:00\n")
    dest = os.path.join(workdir, "transactions")
    rep = ingest.ingest(spark, "transactions", src, dest, rows_per_file=1)
    assert (rep.rows_written, rep.partitions_written, rep.files_written) == (3, 2, 3)
    assert sorted(os.path.basename(os.path.dirname(f)) for f in files_under(dest)) == \
        ["dt=2025-03-09", "dt=2025-03-09", "dt=2025-03-10"]


def test_reload_replaces_the_whole_table(spark, workdir):
    dest = os.path.join(workdir, "affiliate_cpa_ftd")
    old = os.path.join(dest, "ingest_date=2025-06-01")
    os.makedirs(old)
    src = write(os.path.join(workdir, "a.csv"),
                "affiliate_id,player_id,country,clicks,registrations,ftd,cpa_value\n"
                "north,kim,cl,250,31,4,17.5\n")
    ingest.ingest(spark, "affiliate_cpa_ftd", src, dest, ingest_date=dt.date(2025, 6, 2))
    assert not os.path.exists(old)
    df = read_bronze(spark, dest, "affiliate_cpa_ftd", "1900-01-01", "2100-01-01")
    r = df.first()
    assert (r.country, r.clicks, r.ingest_date) == ("cl", "250", dt.date(2025, 6, 2))


def test_missing_required_column_fails_fast(spark, workdir):
    src = write(os.path.join(workdir, "p.csv"), "player_id,email,city\nlee,lee@post.example,Oslo\n")
    with pytest.raises(ingest.MissingColumnsError, match="created_at"):
        ingest.ingest(spark, "players", src, os.path.join(workdir, "out"), source_format="csv")
    assert not os.path.exists(os.path.join(workdir, "out"))


def test_format_dispatch(spark):
    assert ingest.normalize_format("JSON_ARRAY") == "json"
    assert ingest.normalize_format("Csv") == "csv"
    with pytest.raises(ValueError, match="Unsupported source format"):
        ingest.normalize_format("xml")
    assert ingest.landing_uri("players", "s3a://b/landing/") == "s3a://b/landing/players.json"
    assert ingest.landing_uri("players", "x", source_uri="s3://y/p.json") == "s3://y/p.json"
    assert ingest.staging_uri("players", "s3a://b/staging") == "s3a://b/staging/players"


def test_csv_edge_cases(spark, workdir):
    src = write(os.path.join(workdir, "t.csv"),
                'transaction_id,player_id,type,amount,timestamp,extra\n'
                't1,,deposit,"1,5",2026-01-20 10:00:00,x\n'          # empty field -> ''
                't2,"",bet,2,2026-01-20 10:00:00,x\n'               # quoted empty -> ''
                '"t3","p ""q""\nline",bet,3,2026-01-21 10:00:00,x\n')  # quote + newline
    bronze, n = ingest.validate(ingest.read_landing(spark, src, "transactions"))
    got = {r.transaction_id: r for r in bronze.collect()}
    assert n == 3 and "extra" not in bronze.columns
    assert got["t1"].player_id == "" and got["t1"].amount == "1,5"
    assert got["t2"].player_id == ""
    assert got["t3"].player_id == 'p "q"\nline'


def test_csv_short_row_tail_is_null_and_bad_partition_fails(spark, workdir):
    src = write(os.path.join(workdir, "t.csv"),
                "affiliate_id,player_id,country,clicks,registrations,ftd,cpa_value\n"
                "a1,p1,BR\n")
    bronze, _ = ingest.validate(ingest.read_landing(spark, src, "affiliate_cpa_ftd"),
                                ingest_date=dt.date(2026, 1, 1))
    r = bronze.first()
    assert (r.country, r.clicks, r.cpa_value) == ("BR", None, None)
    bad = write(os.path.join(workdir, "b.csv"), TX_CSV.replace("2025-03-09 18:00:59", "09/03/2025"))
    with pytest.raises(ingest.InvalidPartitionError):
        ingest.validate(ingest.read_landing(spark, bad, "transactions"))


def test_json_edge_cases(spark, workdir):
    src = write(os.path.join(workdir, "s.json"),
                '[{"session_id": "s1", "player_id": 7, "ip": null, "device": {"k": 1},'
                ' "timestamp": "2026-01-20 23:00:00-03:00", "other": true},'
                ' {"session_id": "s2", "player_id": 1.50, "ip": "x", "device": true,'
                ' "timestamp": "2026-01-21"}]')
    bronze, n = ingest.validate(ingest.read_landing(spark, src, "sessions"))
    got = {r.session_id: r for r in bronze.collect()}
    assert n == 2
    assert got["s1"].player_id == "7" and got["s1"].ip is None and json.loads(got["s1"].device) == {"k": 1}
    assert got["s1"].dt == dt.date(2026, 1, 20)
    assert got["s2"].player_id == "1.50" and got["s2"].device == "true"
    missing = write(os.path.join(workdir, "m.json"),
                    '[{"session_id": "s1", "player_id": "p", "device": "w", "timestamp": "2026-01-20"}]')
    with pytest.raises(ingest.MissingColumnsError, match="ip"):
        ingest.validate(ingest.read_landing(spark, missing, "sessions"))


def test_empty_input_keeps_old_data(spark, workdir):
    dest = os.path.join(workdir, "players")
    ingest.ingest(spark, "players", write(os.path.join(workdir, "a.json"), json.dumps(
        [{"player_id": "p", "email": "e", "city": "c", "created_at": "2026-01-20"}])), dest)
    rep = ingest.ingest(spark, "players", write(os.path.join(workdir, "b.json"), "[]"), dest)
    assert rep.rows_written == 0
    assert read_bronze(spark, dest, "players", "1900-01-01", "2100-01-01").count() == 1


def test_bronze_read_requires_partition_bounds(spark, workdir):
    with pytest.raises(PartitionFilterRequired):
        read_bronze(spark, workdir, "players", None, "2026-01-01")


def test_bronze_scan_prunes_partitions(spark, workdir):
    src = write(os.path.join(workdir, "t.csv"), TX_CSV + "A-79,kim,deposit,31.10,2025-03-10 00:00:00\n")
    dest = os.path.join(workdir, "transactions")
    ingest.ingest(spark, "transactions", src, dest)
    df = read_bronze(spark, dest, "transactions", "2025-03-10", "2025-03-10")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and df.count() == 1


def test_json_lines_feed(spark, workdir):
    src = write(os.path.join(workdir, "p.jsonl"),
                '{"player_id": "p1", "email": "a@b.c", "city": "x", "created_at": "2026-01-20"}\n'
                '\n'
                '{"player_id": "p2", "email": null, "city": "y", "created_at": "2026-01-21"}\n')
    bronze, n = ingest.validate(ingest.read_landing(spark, src, "players", "jsonl"))
    assert n == 2 and {r.email for r in bronze.collect()} == {"a@b.c", None}


def test_csv_splittable_mode(spark, workdir):
    src = write(os.path.join(workdir, "t.csv"), TX_CSV)
    bronze, n = ingest.validate(ingest.read_landing(spark, src, "transactions", multi_line=False))
    assert n == 2 and {r.amount for r in bronze.collect()} == {"0.50", "1200.00"}


def test_csv_long_row_keeps_declared_columns(spark, workdir):
    src = write(os.path.join(workdir, "t.csv"),
                "transaction_id,player_id,type,amount,timestamp\n"
                "t1,p1,bet,2,2026-01-20 10:00:00,extra1,extra2\n")
    bronze, n = ingest.validate(ingest.read_landing(spark, src, "transactions"))
    r = bronze.first()
    assert n == 1 and (r.transaction_id, r.amount, r.timestamp) == ("t1", "2", "2026-01-20 10:00:00")


def test_header_only_csv_keeps_old_data(spark, workdir):
    dest = os.path.join(workdir, "transactions")
    ingest.ingest(spark, "transactions", write(os.path.join(workdir, "a.csv"), TX_CSV), dest)
    empty = write(os.path.join(workdir, "b.csv"), "transaction_id,player_id,type,amount,timestamp\n")
    rep = ingest.ingest(spark, "transactions", empty, dest)
    assert rep.rows_written == 0
    assert read_bronze(spark, dest, "transactions", "1900-01-01", "2100-01-01").count() == 2


def test_write_bronze_counts_while_writing(spark, workdir):
    from tests.fixtures import bronze
    df = bronze(spark, "players", [("p1", "e", "c", "2026-01-20", "2026-01-20"),
                                   ("p2", "e", "c", "2026-01-21", "2026-01-21")])
    rep = ingest.write_bronze(df, os.path.join(workdir, "p"), "players")
    assert (rep.rows_written, rep.partitions_written) == (2, 2)
    empty = ingest.write_bronze(df.limit(0), os.path.join(workdir, "p"), "players")
    assert empty.rows_written == 0
    assert read_bronze(spark, os.path.join(workdir, "p"), "players", "1900-01-01", "2100-01-01").count() == 2


HEADER = "transaction_id,player_id,type,amount,timestamp"


@pytest.mark.parametrize("way", ["batch", "stream"])
@pytest.mark.parametrize("name,source_format,text,want", [
    ("a.csv", "csv", f"{HEADER}\nt1,,bet,1.50,2026-01-20 10:00:00\n", ("t1", "", "1.50")),
    ("a.jsonl", "jsonl", '{"transaction_id":"t1","player_id":7,"type":"bet","amount":1.50,"timestamp":"2026-01-20"}\n\n', ("t1", "7", "1.50")),
    ("a.json", "json", '[{"transaction_id":"t1","player_id":null,"type":"bet","amount":1.50,"timestamp":"2026-01-20"}]', ("t1", None, "1.50")),
    ("a.csv", "csv", "transaction_id,player_id,type,timestamp\nt1,p,bet,2026-01-20\n", None),
    ("a.jsonl", "jsonl", '{"transaction_id":"t1","player_id":"p","type":"bet","timestamp":"2026-01-20"}\n', None),
    ("a.json", "json", '[{"transaction_id":"t1","player_id":"p","type":"bet","timestamp":"2026-01-20"}]', None),
    ("a.csv", "csv", f"{HEADER}\nt1,p,bet,1,20/01/2026\n", None),
])
def test_files_and_streams_are_parsed_alike(spark, workdir, way, name, source_format, text, want):
    from riskmesh.streaming.micro_loads import land
    landing, out = os.path.join(workdir, "landing"), os.path.join(workdir, "out")
    os.makedirs(landing)
    write(os.path.join(landing, name), text)

    def load():
        if way == "batch":
            ingest.ingest(spark, "transactions", os.path.join(landing, name), out, source_format=source_format)
        else:
            land(spark, landing, "transactions", out, os.path.join(workdir, "checkpoint"), source_format)
        return [(r.transaction_id, r.player_id, r.amount) for r in read_bronze(spark, out, "transactions", "1900-01-01", "2100-01-01").collect()]

    if want is None:
        with pytest.raises(Exception):
            load()
    else:
        assert load() == [want]


def test_a_permuted_header_is_never_mapped_by_position(spark, workdir):
    from riskmesh.streaming.micro_loads import land
    landing = os.path.join(workdir, "landing")
    os.makedirs(landing)
    src = write(os.path.join(landing, "a.csv"), "player_id,transaction_id,type,amount,timestamp\np1,t1,bet,1,2026-01-20 10:00:00\n")
    bronze, _ = ingest.validate(ingest.read_landing(spark, src, "transactions"))
    assert [(r.transaction_id, r.player_id) for r in bronze.collect()] == [("t1", "p1")]
    with pytest.raises(Exception):
        land(spark, landing, "transactions", os.path.join(workdir, "out"), os.path.join(workdir, "checkpoint"))
