import random

from riskmesh.llm.mixing import mix, take
from tests.llm.conftest import WORD, frame, odd_rows


def targets(sizes, weights, share=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while True:
        rate = left / sum(w[s] for s in open_) if open_ else 0
        over = [s for s in open_ if rate * w[s] > most * sizes[s]]
        if not over:
            return out | {s: rate * w[s] for s in open_}
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
            open_.remove(s)


def test_mix_meets_targets(spark):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randrange(0, 60), "en", rng.choice(["s1", "s2", "é", "z", None, "hot", "hot", "hot"])) for i in range(3000)]
    got = mix(frame(spark, rows), [3, 1, 2]).collect()
    assert len(got) == len(rows)
    sizes, taken, largest = {}, {}, {}
    for r in got:
        assert r.taken in (0, r.size, 2 * r.size)
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        largest[r.source] = max(largest.get(r.source, 0), r.size)
    want = targets(sizes, [3, 1, 2])
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * (1 + r.target)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s]
    again = {(r.doc_id, r.taken) for r in mix(frame(spark, rows[::-1]), [3, 1, 2]).collect()}
    assert again == {(r.doc_id, r.taken) for r in got}
    whole = take(frame(spark, rows), [3, 1, 2])
    assert whole.columns == frame(spark, []).columns
    copies = {}
    for r in whole.collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    assert copies == {r.doc_id: r.taken // r.size for r in got if r.taken}


def test_odd_rows_and_empty(spark):
    rows = odd_rows()
    got = mix(frame(spark, rows), [3, 1, 2]).collect()
    assert sorted(str((i, len(WORD.findall(t or "")))) for i, t, _, _ in rows) == sorted(str((r.doc_id, r.size)) for r in got)
    assert mix(frame(spark, []), [3, 1, 2]).count() == 0 and take(frame(spark, []), [3, 1, 2]).count() == 0
    only_empty = mix(frame(spark, [(1, None, None, None), (2, "", None, "a")]), [3, 1, 2]).collect()
    assert [(r.size, r.taken, r.target) for r in only_empty] == [(0, 0, 0.0)] * 2
