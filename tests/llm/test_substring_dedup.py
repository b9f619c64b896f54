import hashlib
import random

import pytest

from riskmesh.llm.substring_dedup import remove_repeats
from tests.llm.conftest import WORD, frame, odd_rows, prose


def brute(rows, window):
    words = [WORD.findall(t or "") for _, t, _, _ in rows]
    count = {}
    for w in words:
        for p in range(len(w) - window + 1):
            k = tuple(w[p:p + window])
            count[k] = count.get(k, 0) + 1
    out = []
    for (i, *_), w in zip(rows, words):
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if count[tuple(w[p:p + window])] > 1:
                gone[p:p + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append(str((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())))
    return sorted(out)


def found(docs, **options):
    return sorted(str((r.doc_id, r.n_words, r.n_removed, r.kept_sha256)) for r in remove_repeats(docs, **options).collect())


@pytest.mark.parametrize("window,block,group_rows", [(35, 7, 500_000), (35, 7, 5), (10, 4, 500_000), (5, 5, 500_000)])
def test_matches_brute_force(spark, window, block, group_rows, monkeypatch):
    import riskmesh.llm.substring_dedup as S
    whole = S.repeated_windows
    monkeypatch.setattr(S, "repeated_windows", lambda docs, w, b: whole(docs, w, b, group_rows))
    rng = random.Random(window)
    shared = [prose(rng, n, [f"w{k}" for k in range(500)]) for n in (9, 34, 35, 36, 80)]
    rows = []
    for i in range(120):
        parts = [prose(rng, rng.randrange(0, 60), [f"w{k}" for k in range(500)])]
        for _ in range(rng.randrange(3)):
            parts += [rng.choice(shared), prose(rng, rng.randrange(0, 20), [f"w{k}" for k in range(500)])]
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(parts), "en", "a"))
    rows += [(900, "again " * 50, "en", "a"), (901, "x y " * 40, "en", "a"), (902, "again " * 35, "en", "a")]
    assert found(frame(spark, rows), window=window, block=block) == brute(rows, window)


def test_odd_rows_and_empty(spark):
    rows = odd_rows()
    assert found(frame(spark, rows)) == brute(rows, 35)
    assert found(frame(spark, [])) == []
    text = {r.doc_id: r.kept_text for r in remove_repeats(frame(spark, [(1, "a b c d", "", ""), (2, "b c d e", "", "")]), 3, 3, with_text=True).collect()}
    assert text == {1: "a", 2: "e"}
