import random

from pyspark.sql import functions as F

from riskmesh.llm.language_id import identify, learn_dictionaries
from tests.llm.conftest import frame, odd_rows, prose

SOUNDS = {"aa": "kata mono shira yuki hana tori sora umi".split(), "bb": "brink stolt varg huld grim fjord skald ting".split(),
          "cc": "palazzo vino bello corso ditta piano sole mare".split()}


def corpus(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(SOUNDS))
        words = SOUNDS[lang]
        rows.append((i, " ".join(rng.choice(words) + rng.choice(words)[:3] for _ in range(rng.randrange(15, 80))), lang, "s"))
    return rows


def test_held_out_accuracy(spark):
    docs = frame(spark, corpus(600, 1))
    dictionaries = learn_dictionaries(docs.where(F.col("doc_id") % 5 != 0), sample_docs=20, dict_bytes=8192)
    assert sorted(dictionaries) == ["aa", "bb", "cc"] and all(len(d) <= 8192 for d in dictionaries.values())
    got = identify(docs, dictionaries).join(docs.select("doc_id", "lang"), "doc_id").where("doc_id % 5 = 0").collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 0.98 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


def test_learning_reads_only_its_rows(spark):
    docs = frame(spark, corpus(80, 2))
    a = learn_dictionaries(docs.where("doc_id < 40"))
    b = learn_dictionaries(docs.where("doc_id < 40").orderBy(F.desc("doc_id")))
    assert a == b


def test_odd_rows(spark):
    rows = [*odd_rows(), (50, "123 456 !!", "aa", "s"), (51, "katamono shirayuki " * 5000, None, None)]
    dictionaries = learn_dictionaries(frame(spark, corpus(60, 3)))
    got = {r.doc_id: r for r in identify(frame(spark, rows), dictionaries).collect()}
    for i in (1, 2, 3, 15, 50):
        assert (got[i].lang_pred, got[i].score, got[i].accepted) == ("und", 0.0, False)
    assert got[51].lang_pred == "aa" and got[13].lang_pred in SOUNDS
    assert identify(frame(spark, rows), dictionaries).count() == len(rows)
    assert {r.lang_pred for r in identify(frame(spark, rows), {}).collect()} == {"und"}
    assert learn_dictionaries(frame(spark, [])) == {} and identify(frame(spark, []), dictionaries).count() == 0


def test_narrow_margins_are_rejected(spark):
    dictionaries = {"aa": b"kata mono shira yuki " * 50, "ab": b"kata mono shira yuki " * 50}
    r = identify(frame(spark, [(1, "kata mono shira", None, None)]), dictionaries).collect()[0]
    assert (r.lang_pred, r.accepted) == ("aa", False)
