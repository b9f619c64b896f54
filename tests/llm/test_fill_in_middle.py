import hashlib
import random
import re

import numpy as np
import pytest

from riskmesh.llm.fill_in_middle import Units, WaveletMatrix, fill_in_middle, restore
from tests.llm.conftest import frame, odd_rows, prose

TOKEN = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def brute(doc_id, text, unit="token"):
    text = text or ""
    tokens = TOKEN.findall(text) if unit == "token" else list(text)
    n, digest = len(tokens), hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i: 8 * i + 8], 16) for i in range(4))
    one, two = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (tokens[:one], tokens[one:two], tokens[two:]))
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text, text
    if h4 % 100 < 20:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", text
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", text


def found(df, **options):
    out = fill_in_middle(df, **options)
    rows = out.select("*", restore(out["output"], out["form"]).alias("back")).collect()
    return sorted(str((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back)) for r in rows)


def cases():
    rng = random.Random(9)
    rows = [(1000 + i, prose(rng, rng.randrange(0, 30)) + rng.choice(["", "é漢🙂a", "<", "<P", "\n\n<S>", "S>", "x<M>y", "\x00b", "12ab3"]), "en", "a") for i in range(150)]
    return rows + [(2000 + i, rng.choice(["<", ">", "<S", "a", "<P", "SP>", "M>", "<M", " "]) * rng.randrange(1, 6), "en", "a") for i in range(100)]


@pytest.mark.parametrize("unit", ["token", "char"])
def test_matches_brute_force(spark, unit):
    rows = cases()
    assert found(frame(spark, rows), unit=unit) == sorted(str(brute(i, t, unit)) for i, t, *_ in rows)


def test_odd_rows_and_empty(spark):
    rows = odd_rows()
    assert found(frame(spark, rows)) == sorted(str(brute(i, t)) for i, t, *_ in rows)
    assert found(frame(spark, [])) == []


def test_wavelet_matrix_ranks():
    rng = np.random.default_rng(2)
    for n in (0, 1, 63, 64, 65, 128, 1000):
        symbols = rng.integers(0, 8, n).astype(np.uint8)
        matrix, at = WaveletMatrix(symbols), np.arange(n + 1)
        for c in range(9):
            assert (matrix.less(c, at) == np.r_[0, np.cumsum(symbols < c)]).all()


def test_every_cut_of_a_text():
    text = "Ab1 cd\té漢x<yz  Q"
    ends = np.cumsum([0] + [len(t) for t in TOKEN.findall(text)])
    raw = np.frombuffer((text * 2).encode(), dtype=np.uint8)
    units = Units(raw, np.array([0, len(text.encode()), len(raw), len(raw)]))
    assert units.n.tolist() == [len(ends) - 1] * 2 + [0]
    for k in range(len(ends)):
        assert units.cut(np.array([k, k, 0])).tolist() == [ends[k], len(text) + ends[k], 2 * len(text)]
