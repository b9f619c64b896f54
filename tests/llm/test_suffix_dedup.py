import hashlib
import random

import numpy as np
import pytest

from riskmesh.llm.suffix_arrays import common_prefixes, smaller_than_successor, suffix_array, words_at
from riskmesh.llm.suffix_dedup import Spans, remove_repeats, repeats_in_block, slices
from tests.llm.conftest import frame, odd_rows, prose


def brute(rows, window):
    texts = [(t or "").encode() for _, t, _, _ in rows]
    count = {}
    for b in texts:
        for p in range(len(b) - window + 1):
            count[b[p:p + window]] = count.get(b[p:p + window], 0) + 1
    out = []
    for (i, *_), b in zip(rows, texts):
        gone = [False] * len(b)
        for p in range(len(b) - window + 1):
            if count[b[p:p + window]] > 1:
                gone[p:p + window] = [True] * window
        spans = [p for p in range(len(b)) if gone[p] and not (p and gone[p - 1])]
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append(str((i, len(b), sum(gone), len(spans), hashlib.sha256(kept).hexdigest())))
    return sorted(out)


def found(docs, **options):
    return sorted(str((r.doc_id, r.n_bytes, r.n_removed, len(r.removed), r.kept_sha256)) for r in remove_repeats(docs, **options).collect())


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(500)] + ["é", "漢字", "\n"]
    shared = [prose(rng, k, words) for k in (8, 40, 50, 51, 52, 120)]
    rows = []
    for i in range(n):
        parts = [prose(rng, rng.randrange(0, 60), words)]
        for _ in range(rng.randrange(3)):
            parts += [rng.choice(shared), prose(rng, rng.randrange(0, 20), words)]
        rows.append((i, rng.choice([" ", "", "漢"]).join(parts), "en", "a"))
    rows += [(900, "again " * 80, "en", "a"), (901, "xy" * 140, "en", "a"), (902, "z" * 200, "en", "a"), (903, "z" * 201, "en", "a"), (904, "\x00" * 230, "en", "a")]
    rows += [(905 + i, rows[3][1], "en", "a") for i in range(4)]
    return rows


@pytest.mark.parametrize("window,gram,block_bytes", [(200, 64, 1 << 20), (200, 64, 900), (50, 20, 1 << 20), (21, 21, 400), (9, 3, 1 << 20)])
def test_matches_brute_force(spark, window, gram, block_bytes):
    rows = corpus(window + gram)
    assert found(frame(spark, rows), window=window, gram=gram, block_bytes=block_bytes) == brute(rows, window)


def test_odd_rows_and_empty(spark):
    rows = odd_rows()
    assert found(frame(spark, rows)) == brute(rows, 200)
    assert found(frame(spark, [])) == []
    kept = {r.doc_id: (r.kept, [tuple(s) for s in r.removed]) for r in
            remove_repeats(frame(spark, [(1, "abcdef", "", ""), (2, "xbcdey", "", ""), (3, "q", "", "")]), 4, 2, with_text=True).collect()}
    assert kept == {1: (b"af", [(1, 5)]), 2: (b"xy", [(1, 5)]), 3: (None, [])}


def test_hot_passage_and_anchor(spark):
    """A passage in every document: the segments at its edges differ everywhere
    and do not fit one block."""
    rng = random.Random(1)
    passage = prose(rng, 100, [f"p{k}" for k in range(80)])
    rows = [(i, prose(rng, 40, [f"v{k}" for k in range(9000)]) + " " + passage + " " + prose(rng, 40, [f"v{k}" for k in range(9000)]), "en", "a") for i in range(60)]
    assert found(frame(spark, rows), block_bytes=2000) == brute(rows, 200)


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(5)
    for trial in range(120):
        n, letters, depth = int(rng.integers(1, 300)), int(rng.integers(1, 5)), int(rng.choice([1, 5, 8, 13, 64, 400]))
        s = rng.integers(0, letters, n).astype(np.uint8) * int(rng.choice([1, 80]))
        if rng.random() < .3:
            s = np.tile(s[: max(1, n // 7)], 7)
        b, n = s.tobytes(), len(s)
        suffixes = [b[i:] for i in range(n)]
        assert smaller_than_successor(s).tolist() == [suffixes[i] < (suffixes[i + 1] if i + 1 < n else b"") for i in range(n)]
        words, at = words_at(s, depth), np.arange(n)
        # as in a block: what lies beyond the end compares like zeros, so end with a byte of its own
        order = suffix_array(s, words, depth, Spans(s).of(at, np.minimum(at + depth, n)))
        assert sorted(order.tolist()) == list(range(n))
        cut = [(b[i:i + depth]).ljust(depth, b"\0") for i in order]
        assert cut == sorted(cut)
        prefixes = common_prefixes(order, words, depth)
        assert prefixes.tolist() == [next((k for k in range(depth) if x[k] != y[k]), depth) for x, y in zip(cut, cut[1:])]


def test_repeats_in_block_counts_weights():
    a, b = (np.frombuffer(x, dtype=np.uint8) for x in (b"abcdefgh", b"xxbcdefy"))
    assert repeats_in_block([a, b], np.array([1, 1]), 5) == [(0, 1, 2), (1, 2, 3)]
    assert repeats_in_block([a, b], np.array([2, 1]), 5) == [(0, 0, 4), (1, 2, 3)]
    assert repeats_in_block([a], np.array([1]), 5) == []


def test_long_texts_come_in_overlapping_slices():
    import pyarrow as pa
    text = "".join(chr(97 + i * 7 % 26) for i in range(1000))
    column = pa.array(["ab", None, text, "", "cd" * 10])
    starts = [(int(r), int(at[k]) + p) for row, at, offsets, raw in slices(column, 9, 64) for k, r in enumerate(row)
              for p in range(int(offsets[k + 1] - offsets[k]) - 9)]
    assert sorted(starts) == [(2, p) for p in range(991)] + [(4, p) for p in range(11)]


def _order(s, words, depth):
    at = np.arange(len(s))
    alike = Spans(s).of(at, np.minimum(at + depth, len(s)))
    return suffix_array(s, words, depth, alike), alike


@pytest.mark.parametrize("depth", [1, 8, 13, 40])
def test_pairs_that_agree_are_those_of_the_common_prefixes(depth):
    from riskmesh.llm.suffix_arrays import agree_with_next
    rng = np.random.default_rng(depth)
    for letters in (1, 2, 5, 200):
        text = rng.integers(1, letters + 1, 300).astype(np.uint8)
        s = np.r_[text, np.uint8(0), text[20:250], np.uint8(0), text[:90], text[100:200], np.uint8(0)]
        words = words_at(s, depth)
        order, alike = _order(s, words, depth)
        want = common_prefixes(order, words, depth) >= depth
        assert (agree_with_next(order, s, words, depth, alike) == want).all()
        assert (agree_with_next(order, s, words, depth, np.zeros_like(alike)) == want).all()     # fingerprints that meet by chance


def test_groups_that_agree_on_a_round_are_not_sorted_in_it(monkeypatch):
    rng = np.random.default_rng(8)
    text = rng.integers(1, 200, 4000).astype(np.uint8)
    other = text.copy()
    other[::150] += 1                                        # long common prefixes that end somewhere
    s, depth, sorted_, lexsort = np.r_[text, np.uint8(0), other, np.uint8(0)], 200, [], np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys: (sorted_.append(len(keys[0])), lexsort(keys))[1])
    words = words_at(s, depth)
    order, _ = _order(s, words, depth)
    raw = s.tobytes()
    assert [raw[i: i + depth] for i in order.tolist()] == sorted(raw[i: i + depth] for i in range(len(raw)))
    assert 0 < sum(sorted_) <= len(s)
