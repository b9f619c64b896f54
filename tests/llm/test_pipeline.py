import collections
import os
import random

import corpus_pipeline
from tests.llm.conftest import frame, odd_rows

SF = "/root/testdata/sf0.001"


def test_stages_pass_on_what_they_keep(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        assert docs.columns == columns
        assert all(before[r.doc_id] == r for r in docs.collect())
        sizes.append(docs.count())
    assert sizes[1] < sizes[0] and sizes[2] <= sizes[1] and sizes[3] <= sizes[2] and all(sizes)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert sorted(r.doc_id for r in last.collect()) == sorted(r.doc_id for r in docs.collect())
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(r.doc_id for r in whole.collect()) == sorted(r.doc_id for r in docs.collect())


def test_one_of_each_group_stays(spark):
    rows = odd_rows()
    got = [(r.doc_id, r.text) for r in corpus_pipeline.ngram_join(spark, frame(spark, rows), SF).collect()]
    want = [(i, t) for i, t, *_ in rows if not (i in (5, 7, 14) or (i is None and t == rows[3][1]) or i == 10)]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_rows_that_share_an_id_are_rows_of_their_own(spark):
    rng = random.Random(2)
    a, b, c, x = (" ".join(f"{name}{rng.randrange(900)}" for _ in range(60)) for name in "abcx")
    rows = [(1, a, "en", "s"), (1, b, "en", "s"), (2, c, "en", "s"), (2, c, "en", "s"), (None, x, "en", "s"), (None, x, "en", "s"), (None, x, "de", "s"), (None, c, "en", "s"), (3, b, "en", "s")]
    got = sorted(map(str, ((r.doc_id, r.text) for r in corpus_pipeline.ngram_join(spark, frame(spark, rows), SF).collect())))
    assert got == sorted(map(str, [(1, a), (1, b), (2, c), (None, x)]))


def test_stages_take_odd_and_empty_tables(spark, tmp_path):
    os.makedirs(tmp_path / "sf", exist_ok=True)
    spark.createDataFrame([(1, "nothing here like any of the documents at all")], "item_id long, text string").write.parquet(str(tmp_path / "sf/benchmark.parquet"))
    for rows in (odd_rows(), []):
        docs = frame(spark, rows)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path / "sf"))
            assert out.count() <= 2 * len(rows)
            if stage is not corpus_pipeline.sharding:
                assert out.columns == docs.columns


def test_near_copies_above_eight_tenths_are_one(spark):
    rng = random.Random(21)
    words = [f"w{k}" for k in range(5000)]

    def grams(text):
        w = text.split()
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}

    rows = []
    for i in range(24):
        text = " ".join(rng.choice(words) for _ in range(200))
        footer = " ".join(rng.choice(words) for _ in range(22 + 3 * i))  # similarity 0.90 down to 0.68
        rows += [(2 * i, text, "en", "a"), (2 * i + 1, f"{text} {footer}", "en", "a")]
    want = set()
    for (i, a, *_), (j, b, *_) in zip(rows[::2], rows[1::2]):
        a, b = grams(a), grams(b)
        want |= {i} if 100 * len(a & b) >= 80 * len(a | b) else {i, j}
    assert 24 < len(want) < 48
    assert {r.doc_id for r in corpus_pipeline.ngram_join(spark, frame(spark, rows), SF).collect()} == want
