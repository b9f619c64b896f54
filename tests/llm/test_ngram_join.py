import itertools
import random

import numpy as np
import pytest

from riskmesh.llm.ngram_join import similar, trie_links
from tests.llm.conftest import A_TO_Z, WORD, frame, odd_rows, prose


def sets_of(text, n=3):
    w = WORD.findall((text or "").translate(A_TO_Z))
    if len(w) < n:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1))


def groups(sets, percent):
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, j in itertools.combinations(range(len(sets)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            parent[find(i)] = find(j)
    return [find(i) for i in range(len(sets))]


def check(rows, got, percent):
    sets = [sets_of(t) for _, t, _, _ in rows]
    part = groups(sets, percent)
    want = []
    for k, (i, t, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if part[j] == part[k] and rows[j][0] is not None]
        want.append(str((i, len(sets[k]), min(ids) if ids else None)))
    assert sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in got) == sorted(want)


def variants(rng):
    rows = []
    for g in range(25):
        base = prose(rng, rng.randrange(3, 150), [f"w{k}" for k in range(400)]).split()
        for _ in range(rng.randrange(1, 9)):
            words = list(base)
            for _ in range(rng.randrange(0, 3)):
                words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
            rows.append((len(rows), (" " if rng.random() < .5 else "\n").join(words).upper() if rng.random() < .2 else " ".join(words), "en", "a"))
    return rows


@pytest.mark.parametrize("percent", [90, 70])
def test_matches_all_pairs(spark, percent):
    rows = variants(random.Random(7)) + [(5000 + i, t, a, b) for i, (_, t, a, b) in enumerate(odd_rows())]
    check(rows, similar(frame(spark, rows), 3, percent).collect(), percent)


def test_blocks_give_the_same(spark):
    rows = variants(random.Random(8))
    check(rows, similar(frame(spark, rows), 3, 90, block_elements=300).collect(), 90)


def test_odd_rows_and_empty(spark):
    rows = odd_rows()
    check(rows, similar(frame(spark, rows), 3, 90).collect(), 90)
    assert similar(frame(spark, [])).count() == 0


def test_trie_links_are_links_and_span_the_groups():
    rng = random.Random(3)
    for _ in range(60):
        base = [rng.sample(range(200), rng.randrange(1, 40)) for _ in range(4)]
        sets = set()
        for _ in range(rng.randrange(2, 25)):
            s = set(rng.choice(base))
            for _ in range(rng.randrange(4)):
                s.symmetric_difference_update([rng.randrange(400)])
            if s:
                sets.add(frozenset(s))
        sets, percent = list(sets), rng.choice([60, 80, 90])
        links = trie_links([np.sort(np.array(list(s), dtype=np.uint64)) for s in sets], percent)
        assert all(100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) for a, b in links)
        part = groups(sets, percent)
        assert len(links) == len(sets) - len(set(part)) and all(part[a] == part[b] for a, b in links)
