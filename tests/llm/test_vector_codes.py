import hashlib
import math
import random

import numpy as np
import pytest

from riskmesh.llm.vector_codes import Codebook, Gnat, compress

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error long, id long, vector string"


def brute(rows, parts=8, k=16, rounds=6):
    """rows: (vec_id, vector or None, label)"""
    kept = [(i, [math.floor(4096 * float(np.float32(v))) for v in x], label) for i, x, label in rows
            if x is not None and all(v is not None and math.isfinite(np.float32(v)) for v in x)]
    width = -(-max([len(x) for _, x, _ in kept], default=0) // parts) * parts
    kept = [(i, x + [0] * (width - len(x)), label) for i, x, label in kept]
    step = width // parts
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0))[:k]
    books = [[x[p * step:(p + 1) * step] for _, x, _ in first] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x[p * step:(p + 1) * step], e)), j) for j, e in enumerate(books[p]))
    for _ in range(rounds):
        new = []
        for p in range(parts):
            to = [near(p, x)[1] for _, x, _ in kept]
            new.append([[sum(v) // to.count(j) for v in zip(*[x[p * step:(p + 1) * step] for (_, x, _), t in zip(kept, to) if t == j])] if j in to else e
                        for j, e in enumerate(books[p])])
        books = new
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    found = [(i, label, [near(p, x) for p in range(parts)]) for i, x, label in kept]
    top = (1 << 63) - 1
    total = {}
    for _, label, f in found:
        total[label] = total.get(label, 0) + min(sum(d for d, _ in f), top)
    return sorted(str((i, "".join(f"{j:02x}" for _, j in f), min(sum(d for d, _ in f), top), min(total[label], top), digest)) for i, label, f in found)


def found(spark, rows, **options):
    df = spark.createDataFrame([(i, x, label, "c", 1, 2, "v") for i, x, label in rows], SCHEMA)
    return sorted(str((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256)) for r in compress(df, **options).collect())


@pytest.mark.parametrize("k,parts", [(16, 8), (5, 2)])
def test_matches_brute_force(spark, k, parts):
    rng = random.Random(k)
    centres = [[rng.gauss(0, 1) for _ in range(16)] for _ in range(12)]
    rows = [(i, [rng.gauss(v, .2) for v in rng.choice(centres)], rng.choice([0, 1, None])) for i in rng.sample(range(5000), 300)]
    rows += [(6000 + i, [rng.choice([-1.0, 0.0, 1.0]) for _ in range(16)], 2) for i in range(100)]   # ties
    assert found(spark, rows, entries=k, parts=parts) == brute(rows, parts, k)


def test_odd_rows_and_empty(spark):
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(16)], i % 3) for i in range(30)]
    rows += [(100, None, 1), (101, [float("nan")] * 16, 1), (102, [None] + [0.0] * 15, 1), (103, [float("inf")] + [0.0] * 15, None),
             (None, [0.5] * 16, None), (None, [0.25] * 16, None), (3, [0.1] * 16, 7), (3, [0.1] * 16, 7), (104, [0.5] * 5, 1), (105, [], 2)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []
    assert found(spark, [(1, None, 1), (2, [float("nan")], 2)]) == []
    assert found(spark, rows[:3]) == brute(rows[:3])


def test_huge_components_stay_exact(spark):
    rng = random.Random(6)
    rows = [(i, [rng.uniform(-1, 1) * 10.0 ** rng.randrange(0, 9) for _ in range(8)], 1) for i in range(60)]
    want = brute(rows)
    assert found(spark, rows) == sorted(want)
    top = (1 << 63) - 1
    assert all(r.error == top for r in compress(spark.createDataFrame([(i, [3e38 * (i % 2) + i] * 8, 1, "c", 1, 2, "v") for i in range(40)], SCHEMA), entries=1).collect())


def test_tree_leaves_subtrees_out_and_is_exact():
    rng = np.random.default_rng(3)
    for trial in range(40):
        n, width = int(rng.integers(1, 60)), int(rng.integers(1, 9))
        scale = int(rng.choice([2, 50, 5000]))
        entries = rng.integers(-scale, scale, (n, width))
        queries = np.concatenate([rng.integers(-scale, scale, (200, width)), entries])
        d = ((queries[:, None, :] - entries[None]) ** 2).sum(-1)
        which, best = Codebook(entries.tolist()).nearest(queries)
        assert (which == d.argmin(1)).all() and (best == d.min(1)).all()
        which, best = Codebook(entries.tolist()).nearest(queries.astype(object))
        assert (which == d.argmin(1)).all() and (best == d.min(1)).all()
    centres = rng.integers(-4000, 4000, (16, 8))
    queries = centres[rng.integers(0, 16, 5000)] + rng.integers(-50, 50, (5000, 8))
    best, which = ((queries - centres[0]) ** 2).sum(-1), np.zeros(5000, dtype=np.int64)
    assert Gnat(centres).search(queries, np.arange(5000), best, which) < 0.7 * 5000 * 16
