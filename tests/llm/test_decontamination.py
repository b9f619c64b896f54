import random

import numpy as np

from riskmesh.llm.decontamination import Embedding, clean, contaminated, edit_match, expected_recall
from tests.llm.conftest import frame, odd_rows, prose

VOCABULARY = [f"w{k}" for k in range(600)] + ["the", "of", "and"] * 100


def nearest(item, words):
    """Edits from item to the nearest stretch of words."""
    row = [0] * (len(words) + 1)
    for i, w in enumerate(item):
        new = [i + 1]
        for j, x in enumerate(words):
            new.append(min(row[j] + (w != x), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        kind = rng.randrange(3)
        words[at:at + 1] = [[], [words[at], f"n{rng.randrange(10**6)}"], [f"n{rng.randrange(10**6)}"]][kind]
    return words


def test_finds_what_brute_force_finds(spark):
    rng = random.Random(1)
    items = [(k, prose(rng, rng.randrange(12, 60), VOCABULARY)) for k in range(30)]
    docs, planted = [], 0
    for i in range(400):
        words = prose(rng, rng.randrange(0, 120), VOCABULARY).split()
        if rng.random() < .4:
            k, t = rng.choice(items)
            n = len(t.split())
            words += edited(rng, t.split(), rng.randrange(0, n // 5 + 2)) + prose(rng, rng.randrange(30), VOCABULARY).split()
        docs.append((i, " ".join(w.upper() + rng.choice(["", ",", "."]) if rng.random() < .1 else w for w in words), "en", "a"))
    plain = {i: "".join(c if c.isalnum() else " " for c in t.lower()).split() for i, t, _, _ in docs}
    want = {}
    for i, words in plain.items():
        for k, t in items:
            d = nearest(t.split(), words)
            if d <= len(t.split()) // 5:
                want[i, k] = d
    bench = spark.createDataFrame([(k, t, 1) for k, t in items], "item_id int, text string, distance int")
    got = {(r.doc_id, r.item_id): r.distance for r in contaminated(frame(spark, docs), bench).collect()}
    assert all(want.get(k) == d for k, d in got.items())
    assert len(want) > 100 and len(got) >= 0.95 * len(want)
    assert all(k in got for k, d in want.items() if d == 0)
    blocks = {(r.doc_id, r.item_id): r.distance for r in contaminated(frame(spark, docs), bench, block_items=7).collect()}
    assert blocks.keys() >= {k for k, d in want.items() if d == 0} and len(blocks) >= 0.95 * len(want)
    left = clean(frame(spark, docs), bench)
    assert left.columns == frame(spark, []).columns
    assert {r.doc_id for r in left.collect()} == {i for i, *_ in docs} - {i for i, _ in got}


def test_edit_match_is_exact():
    rng = random.Random(2)
    for _ in range(200):
        item = [rng.randrange(6) for _ in range(rng.randrange(1, 9))]
        words = [rng.randrange(6) for _ in range(rng.randrange(0, 15))]
        d, most = nearest(item, words), rng.randrange(0, 4)
        found = edit_match(np.array(item), np.array(words, dtype=int), most)
        assert (found[0] if found else None) == (d if d <= most else None)


def test_expected_recall():
    assert expected_recall(Embedding(), 40, 4, 100) >= 0.95 and expected_recall(Embedding(), 15, 2, 100) >= 0.95


def test_odd_rows_and_empty(spark):
    rows = odd_rows()
    same = next(t for i, t, _, _ in rows if i == 4)
    items = [(1, same), (1, same), (2, None), (3, ""), (4, "the of"), (None, same + " end")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = contaminated(frame(spark, rows), bench).collect()
    assert sorted(str(r.doc_id) for r in got if r.item_id == 1) == sorted(str(i) for i, t, _, _ in rows if t and t.startswith(same) for _ in range(2))
    assert {r.doc_id for r in got if r.item_id is None and r.distance == 0} == {7} and not [r for r in got if r.item_id in (2, 3, 4)]
    assert contaminated(frame(spark, []), bench).count() == 0 and contaminated(frame(spark, rows), bench.limit(0)).count() == 0
    assert clean(frame(spark, rows), bench.limit(0)).count() == len(rows) and clean(frame(spark, []), bench).count() == 0
