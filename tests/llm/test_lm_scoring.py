import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskmesh.llm import attention_lm
from riskmesh.llm.lm_scoring import score
from tests.llm.conftest import A_TO_Z, WORD, frame, odd_rows, prose


def held(of=5, at=1):
    return F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8")) % of == at


def is_held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1


def brute_base(rows):
    tokens = [[*WORD.findall((t or "").translate(A_TO_Z)), None] for _, t, _, _ in rows]
    count, total = {}, 0
    for (i, *_), own in zip(rows, tokens):
        if not is_held(i):
            for w in own:
                count[w] = count.get(w, 0) + 1
            total += len(own)
    over = total + 0.5 * (len(count) + 1)
    return [(i, is_held(i), len(own), sum(w in count for w in own), total, sum(math.log10((count.get(w, 0) + 0.5) / over) for w in own))
            for (i, *_), own in zip(rows, tokens)]


@pytest.mark.parametrize("table_words", [0, 12, 500_000])
def test_base_matches_brute_force(spark, table_words):
    rng = random.Random(6)
    rows = [(i, prose(rng, rng.randrange(0, 90), [f"W{k}" for k in range(150)] + ["the"] * 100), "en", "a") for i in range(150)] + \
        [(1000 if i is None else i + 1000, t, a, b) for i, t, a, b in odd_rows() if t is None or len(t) < 10_000] + [(None, "the W1 nowhere", "en", "a")]
    got = score(frame(spark, rows), held(), table_words=table_words, sample_docs=5).collect()
    assert len(got) == len(rows)
    line = lambda r: str((*r[:5], round(r[5], 6)))
    assert sorted(line((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score)) for r in got) == sorted(map(line, brute_base(rows)))
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_empty_tables(spark):
    assert score(frame(spark, []), held()).count() == 0
    only_held = [(i, "a b c", "en", "a") for i in range(40) if is_held(i)]
    got = score(frame(spark, only_held), held()).collect()
    assert len(got) == len(only_held) and {(r.n_known, r.train_tokens) for r in got} == {(0, 0)}
    assert all(math.isfinite(r.base_score) and math.isfinite(r.score) for r in got)


def toy(seed=0, texts=60):
    """Sequences over 30 ids in which every id follows from the one two before it."""
    rng = np.random.default_rng(seed)
    parts = []
    for _ in range(texts):
        x = list(rng.integers(0, 30, 2))
        for _ in range(rng.integers(0, 60)):
            x.append((x[-2] + 1) % 30 if rng.random() < .9 else int(rng.integers(30)))
        parts.append(np.array([*x, 30]))
    return np.concatenate(parts), np.cumsum([0, *map(len, parts)])


def test_model_learns_context_and_is_a_distribution():
    ids, first = toy()
    counts = np.bincount(ids, minlength=31).astype(float)
    m = attention_lm.train(ids, first, counts, 30, context=4, stride=8, alone=31, groups=2, own_inputs=31, steps=400)
    held_ids, held_first = toy(1)
    ln = attention_lm.score(m, m.tables(), held_ids, held_first)
    unigram = np.log((counts + .5) / (counts + .5).sum())[held_ids].sum()
    assert ln.sum() > 0.7 * unigram  # both negative: far more likely than by counts alone
    # the probabilities of all continuations of a text sum to 1
    some = held_ids[:9]
    whole = [attention_lm.score(m, m.tables(), np.append(some, x), np.array([0, 10]))[0] for x in range(31)]
    before = attention_lm.score(m, m.tables(), some, np.array([0, 9]))[0]
    assert abs(np.exp(np.array(whole) - before).sum() - 1) < 1e-3


def test_windows_score_each_token_once_as_one_by_one():
    ids, first = toy(2, 20)
    counts = np.bincount(ids, minlength=31).astype(float)
    m = attention_lm.train(ids, first, counts, 30, context=4, stride=8, alone=20, groups=4, own_inputs=16, steps=30)
    t = m.tables()
    together = attention_lm.score(m, t, ids, first)
    p = m.p
    for i in range(len(first) - 1):
        own, total = ids[first[i]: first[i + 1]], 0.0
        for k in range(len(own)):
            start = k // 8 * 8  # the window that scores token k reads from 4 tokens before its first
            seen = [own[j] if j >= 0 else 30 for j in range(start - 5, k)]
            x = p["E"][m.inputs[seen]] + p["P"][: len(seen)]
            a = np.exp((x[-1] @ p["Wq"]) @ (x @ p["Wk"]).T / np.sqrt(p["E"].shape[1]))
            logits = (a / a.sum()) @ (x @ p["Wv"]) @ p["U"] + p["T"][m.inputs[seen[-1]]]
            logits = logits.astype(float)
            total += logits[m.classes[own[k]]] - np.log(np.exp(logits).sum()) + m.within[own[k]]
        assert abs(total - together[i]) < 1e-3 * (1 + abs(total))
    assert abs(attention_lm.score(m, t, ids, first, batch=3) - together).max() < 1e-3


def transitions(ids, first, end, calls):
    def gather(inputs, classes, n_rows, n_classes):
        calls.append(1)
        out = np.zeros((n_rows, n_classes))
        for a, b in zip(first[:-1], first[1:]):
            for x, y in zip([end, *ids[a:b - 1]], ids[a:b]):
                out[inputs[x], classes[y]] += 1
        return out.ravel()
    return gather


def chain(seed, texts):
    """Sequences over 30 ids in which the next id follows from the last one."""
    rng = np.random.default_rng(seed)
    parts = []
    for _ in range(texts):
        x = [int(rng.integers(30))]
        for _ in range(rng.integers(0, 60)):
            x.append((7 * x[-1] + 1) % 30 if rng.random() < .7 else int(rng.integers(30)))
        parts.append(np.array([*x, 30]))
    return np.concatenate(parts), np.cumsum([0, *map(len, parts)])


def test_transitions_of_the_whole_corpus_are_used():
    few, small = chain(1, 3), dict(context=4, stride=8, alone=31, groups=2, own_inputs=31, steps=60)
    held_ids, held_first = chain(9, 40)
    scores = []
    for n in (3, 30, 600):
        ids, first = chain(1, n)
        counts, calls = np.bincount(ids, minlength=31).astype(float), []
        m = attention_lm.train(*few, counts, 30, gather=transitions(ids, first, 30, calls), **small)
        assert calls == [1]
        scores.append(attention_lm.score(m, m.tables(), held_ids, held_first).sum())
        whole = [attention_lm.score(m, m.tables(), np.append(held_ids[:5], x), np.array([0, 6]))[0] for x in range(31)]
        assert abs(np.exp(np.array(whole) - attention_lm.score(m, m.tables(), held_ids[:5], np.array([0, 5]))[0]).sum() - 1) < 1e-3
    assert scores[0] < scores[1] < scores[2]


def test_transitions_are_counted_over_all_training_rows(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, prose(rng, rng.randrange(0, 40)), "en", "a") for i in range(60)] + [(70, None, "en", "a"), (71, "", "en", "a")]
    seen, train = {}, attention_lm.train

    def spy(ids, first, counts, begin, **options):
        options = options | {"steps": 3}
        inner = options["gather"]
        options["gather"] = lambda *a: seen.setdefault("cells", inner(*a))
        return train(ids, first, counts, begin, **options)

    monkeypatch.setattr(attention_lm, "train", spy)
    got = score(frame(spark, rows), held(), sample_docs=5).collect()
    training = [i for i, *_ in rows if not is_held(i)]
    import riskmesh.llm.lm_scoring as L
    encoder, _ = L._encoder(open(L.TOKENIZER, "rb").read())
    tokens = sum(len(encoder.encode_ordinary("".join(" " + w for w in WORD.findall((t or "").translate(A_TO_Z))))) + 1 for i, t, *_ in rows if i in training)
    assert seen["cells"].sum() == tokens and len(got) == len(rows)


def test_one_pass_over_a_larger_corpus_improves_the_attention():
    few, small = toy(1, 4), dict(context=4, stride=8, alone=31, groups=2, own_inputs=31, steps=60)
    ids, first = toy(1, 1500)
    held_ids, held_first = toy(9, 60)
    counts = np.bincount(ids, minlength=31).astype(float)
    m = attention_lm.train(*few, counts, 30, gather=transitions(ids, first, 30, []), **small)
    parts = []
    for a in range(0, 1500, 500):     # three tasks, averaged
        fit = attention_lm.Fit(m, batch=16)
        fit.texts(ids[first[a]: first[a + 500]], first[a: a + 501] - first[a])
        parts.append((fit.windows, fit.weights()))
    assert sum(n for n, _ in parts) == sum(-(-np.diff(first) // 8))      # every window is in a step
    fitted = attention_lm.with_weights(m, np.average([w for _, w in parts], axis=0, weights=[n for n, _ in parts]))
    ln = lambda x: attention_lm.score(x, x.tables(), held_ids, held_first).sum()
    assert ln(fitted) > ln(m) + 0.01 * len(held_ids)
    whole = [attention_lm.score(fitted, fitted.tables(), np.append(held_ids[:5], x), np.array([0, 6]))[0] for x in range(31)]
    assert abs(np.exp(np.array(whole) - attention_lm.score(fitted, fitted.tables(), held_ids[:5], np.array([0, 5]))[0]).sum() - 1) < 1e-3


def test_every_training_document_takes_part_in_classes_and_fit(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, prose(rng, rng.randrange(0, 40)), "en", "a") for i in range(60)]
    seen, train, put = {}, attention_lm.train, attention_lm.with_weights

    def spy(ids, first, counts, begin, **options):
        inner = options["neighbours"]
        options["neighbours"] = lambda *a: seen.setdefault("near", inner(*a))
        seen["counts"] = counts
        return train(ids, first, counts, begin, **options | {"steps": 3})

    def spy_put(m, flat):
        seen["before"], seen["after"] = m, put(m, flat)
        return seen["after"]

    monkeypatch.setattr(attention_lm, "train", spy)
    monkeypatch.setattr(attention_lm, "with_weights", spy_put)
    score(frame(spark, rows), held(), sample_docs=2).collect()
    assert seen["near"].sum() == 2 * seen["counts"].sum()                 # one code before and one behind every token
    assert not np.array_equal(seen["before"].p["E"], seen["after"].p["E"]) and np.isfinite(seen["after"].p["E"]).all()
    assert np.array_equal(seen["before"].p["T"], seen["after"].p["T"])


def test_texts_are_cut_into_subwords_once(spark, monkeypatch):
    """The passes that learn and score read written numbers, not texts."""
    from riskmesh.llm import lm_scoring
    kept, write = {}, lm_scoring.written

    def record(df, name):
        kept[name] = write(df, name)
        return kept[name]

    monkeypatch.setattr(lm_scoring, "written", record)
    rows = [(1, "One two  two"), (2, None), (3, ""), (4, "über zwei"), (5, "one")]
    out = lm_scoring.score(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") == 5)
    assert out.count() == 5
    tokens = {r["doc_id"]: r for r in kept["tokens"].collect()}
    assert {k: len(r["words"]) // 8 for k, r in tokens.items()} == {1: 3, 2: 0, 3: 0, 4: 2, 5: 1}
    assert tokens[5]["words"] == tokens[1]["words"][:8] and tokens[1]["words"][8:16] == tokens[1]["words"][16:]
    assert tokens[2]["ids"] == tokens[3]["ids"] == tokens[1]["ids"][-2:]        # the end alone
    assert tokens[5]["ids"][:-2] == tokens[1]["ids"][: len(tokens[5]["ids"]) - 2]


def test_places_of_hashes():
    from riskmesh.llm.lm_scoring import Places
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 7, 1000):
        keys = np.unique(np.r_[rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2), np.arange(min(n, 5), dtype=np.uint64)])
        hashes = np.r_[keys, keys + np.uint64(1), np.array([0, 2**64 - 1], dtype=np.uint64)]
        at, there = Places(keys).of(hashes)
        assert (at == np.searchsorted(keys, hashes)).all() and (there == np.isin(hashes, keys)).all()


def test_gradients_are_those_of_the_loss():
    from riskmesh.llm import attention_lm as lm
    rng = np.random.default_rng(4)
    n, context, stride, d, rows, classes = 3, 2, 4, 5, 9, 6
    span = context + stride
    p = {k: rng.standard_normal(s) * 0.5 for k, s in {"E": (rows, d), "P": (span, d), "Wq": (d, d), "Wk": (d, d), "Wv": (d, d), "U": (d, classes), "T": (rows, classes)}.items()}
    row, goal, ok = rng.integers(0, rows, (n, span)), rng.integers(0, classes, (n, stride)), rng.random((n, stride)) < 0.8
    mask = (np.arange(span)[None, :] <= np.arange(stride)[:, None] + context).astype(float)

    def loss():
        x = p["E"][row] + p["P"]
        a = np.exp(x[:, context:] @ p["Wq"] @ (x @ p["Wk"]).transpose(0, 2, 1) / np.sqrt(d)) * mask
        y = p["T"][row[:, context:]] + (a / a.sum(axis=2, keepdims=True)) @ (x @ p["Wv"]) @ p["U"]
        own = np.take_along_axis(y, goal[:, :, None], axis=2)[:, :, 0]
        return (np.log(np.exp(y).sum(axis=2)) - own)[ok].mean()

    g = lm.gradients(p, row, goal, ok, context, mask, True)
    for name, values in p.items():
        for at in [tuple(rng.integers(0, s) for s in values.shape) for _ in range(6)]:
            before, sides = values[at], []
            for step in (1e-4, -1e-4):
                values[at] = before + step
                sides.append(loss())
            values[at] = before
            assert abs((sides[0] - sides[1]) / 2e-4 - g[name][at]) < 1e-4, (name, at)


def test_words_are_counted_without_a_second_aggregate_in_the_task(spark, monkeypatch):
    from riskmesh.llm import lm_scoring
    plans, write = {}, lm_scoring.written

    def record(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(lm_scoring, "written", record)
    lm_scoring.score(spark.createDataFrame([(1, "one two two"), (2, "two")], "doc_id long, text string"), F.col("doc_id") == 5)
    assert plans["counts"].count("Exchange") == 1 and plans["counts"].rindex("HashAggregate") < plans["counts"].index("Exchange")


def test_windows_meet_products_of_the_matrices():
    """Keys and values are not laid out; Adam, whose moments lack their factors, steps as by the book."""
    rng = np.random.default_rng(5)
    p = {"E": rng.standard_normal((6, 3)).astype(np.float32)}
    own, first, second = p["E"].astype(float), 0.0, 0.0
    adam = attention_lm.Adam(p)
    for step in range(1, 6):
        g = rng.standard_normal((6, 3)).astype(np.float32)
        first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g.astype(float)**2
        own = own - 0.02 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        adam.step({"E": g.copy()}, 0.02)
        assert abs(own - p["E"]).max() < 1e-5
    ids = np.arange(9) % 4
    m = attention_lm.train(ids, np.array([0, 9]), np.bincount(ids, minlength=6).astype(float), 5, context=2, stride=3, alone=4, groups=2, own_inputs=4, steps=2)
    t = m.tables()
    assert set(t) == {"q", "qp", "VU", "T", "mask"} and t["VU"].shape == m.p["U"].shape
