"""Quality rules: base word counts of every text, and the divergence of its
character-class and common-word histograms from language references.

References are learned from all rows: per language, the histogram of character
classes and the histogram of its ``common`` most frequent words (everything
else is one further bin). A text is compared with every language by the
Jensen-Shannon distance (base 2, 0 to 1) and judged by its nearest language, so
a wrong or missing label costs nothing.

How far a text without any common word is from a reference depends on that
reference alone (on how much of it the common words cover), so the word
distance is also taken relative to that: a text fails if it is nearly as far
(``max_relative``) and holds less than ``min_coverage`` of the common words that
the reference lets expect, where at least ``min_common`` are expected. Texts with fewer than ``min_words``
words or ``min_chars`` characters give histograms too thin to judge; the
method passes them (the base rule judges them).

Defined cases: a null or empty text has no words and fails the base rule; rows
without a language are judged but teach nothing; without any reference (empty
table, no language) the method passes every text; repeated rows are judged one
by one; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskmesh.llm.shared import written
from riskmesh.llm.words import Texts, grams, per_row, repeated, texts

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True

# character class of a byte; continuation bytes of UTF-8 have none (-1)
VOWEL, CONSONANT, UPPER, DIGIT, BLANK, STOP, QUOTE, SYMBOL, CONTROL, WIDE = range(10)
N_CLASSES = 10
CLASS = np.full(256, SYMBOL, dtype=np.int64)
CLASS[0:32] = CONTROL
CLASS[[0x20, *range(0x09, 0x0E)]] = BLANK
CLASS[48:58], CLASS[65:91], CLASS[97:123] = DIGIT, UPPER, CONSONANT
CLASS[list(b"aeiouy")] = VOWEL
CLASS[list(b".,;:!?-")] = STOP
CLASS[list(b"'\"()[]{}")] = QUOTE
CLASS[0x7F], CLASS[0x80:0xC0], CLASS[0xC0:] = CONTROL, -1, WIDE

MAX_LANGUAGES = 512


@dataclass
class Reference:
    lang: str
    classes: np.ndarray  # N_CLASSES shares
    words: np.ndarray    # sorted hashes of the common words
    shares: np.ndarray   # their shares, then the share of all other words


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, kind, key, n): counts of one task's character classes (kind 0),
    words (kind 1) and all words (kind 2) by language."""
    langs: dict[str, int] = {}
    words: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    classes: dict[int, np.ndarray] = {}

    def merge(parts):
        lang, key, n = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((key, lang))
        lang, key, n = lang[order], key[order], n[order]
        new = np.flatnonzero(np.r_[True, (lang[1:] != lang[:-1]) | (key[1:] != key[:-1])])
        return lang[new], key[new], np.add.reduceat(n, new)

    for batch in batches:
        names = batch.column(1).to_pylist()
        code = np.array([-1 if x is None else langs.setdefault(x, len(langs)) for x in names], dtype=np.int64)
        for begin, t in texts(batch.column(0)):
            own = code[begin: begin + t.n]
            hist = _class_histograms(t)
            for c in np.unique(own[own >= 0]):
                classes[c] = classes.get(c, 0) + hist[own == c].sum(axis=0)
            lang, keep = own[t.row], own[t.row] >= 0
            if keep.any():
                key = t.hashes()[keep]
                words.append(merge([(lang[keep], key, np.ones(len(key), dtype=np.int64))]))
            if len(words) >= 16:
                words = [merge(words)]
    name = {c: x for x, c in langs.items()}
    rows = [(np.full(N_CLASSES, c), np.arange(N_CLASSES, dtype=np.uint64), n) for c, n in classes.items()]
    totals = [(lang[:1], np.zeros(1, dtype=np.uint64), np.array([n.sum()]))
              for lang, n in ((lang[lang == c], n[lang == c]) for lang, _, n in words for c in np.unique(lang))]
    for kind, parts in ((0, rows), (1, words), (2, totals)):
        if parts:
            lang, key, n = merge(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name[c] for c in lang.tolist()], pa.string()), pa.array(np.full(len(key), kind), pa.int32()),
                 pa.array(key.view(np.int64)), pa.array(n)], ["lang", "kind", "key", "n"])


def language_references(docs: DataFrame, common: int = 64) -> list[Reference]:
    """References of all languages of ``docs`` (columns text, lang). What comes
    to the driver is at most ``common`` + 10 rows a language; more than
    ``MAX_LANGUAGES`` languages are refused, not cut."""
    counts = docs.select("text", "lang").mapInArrow(_learn, "lang string, kind int, key long, n long") \
        .groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))
    totals = Window.partitionBy("lang", "kind")
    ranked = counts.withColumn("at", F.row_number().over(totals.orderBy(F.desc("n"), "key"))) \
        .where(F.col("at") <= F.lit(max(common, N_CLASSES)))
    kept = written(ranked, "references")
    if kept.where("kind = 0").select("lang").distinct().limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    found: dict[str, dict[int, dict[int, int]]] = {}
    for r in kept.collect():
        found.setdefault(r["lang"], {0: {}, 1: {}, 2: {}})[r["kind"]][r["key"]] = r["n"]
    out = []
    for lang, kinds in sorted(found.items()):
        classes = np.array([kinds[0].get(c, 0) for c in range(N_CLASSES)], dtype=float)
        top = sorted(kinds[1].items(), key=lambda x: (-x[1], x[0]))[:common]
        if not top or not classes.sum():
            continue
        keys = np.array([k for k, _ in top], dtype=np.int64).view(np.uint64)
        n = np.array([n for _, n in top], dtype=float)
        order = np.argsort(keys)
        rest = kinds[2][0] - n.sum()
        out.append(Reference(lang, classes / classes.sum(), keys[order], np.append(n[order], rest) / (n.sum() + rest)))
    return out


def _class_histograms(t: Texts) -> np.ndarray:
    cls = CLASS[t.raw]
    row = np.repeat(np.arange(t.n), np.diff(t.offsets))
    ok = cls >= 0
    return np.bincount(row[ok] * N_CLASSES + cls[ok], minlength=t.n * N_CLASSES).reshape(t.n, N_CLASSES)


def jensen_shannon(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Distance of every row of ``p`` from ``q`` (rows and ``q`` sum to 1)."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=1)
        b = np.where(q > 0, q * np.log2(q / m), 0).sum(axis=1)
    return np.sqrt(np.clip((a + b) / 2, 0, 1))


def _shares(hist: np.ndarray) -> np.ndarray:
    return hist / np.maximum(hist.sum(axis=1, keepdims=True), 1)


def _word_histograms(t: Texts, hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
    at = np.where(words[at] == hashes, at, len(words))
    k = len(words) + 1
    return np.bincount(t.row * k + at, minlength=t.n * k).reshape(t.n, k)


def base_counts(t: Texts, hashes: np.ndarray) -> dict[str, np.ndarray]:
    n_words = t.n_words()
    lead = (t.raw & 0xC0) != 0x80
    # lines: pieces between line feeds and row borders; a line counts if it has a word
    feeds = np.flatnonzero(t.raw == 10)
    begin = np.union1d(t.offsets[:-1], feeds + 1)
    begin = begin[begin < len(t.raw)]
    row = np.searchsorted(t.offsets, begin, side="right") - 1
    end = np.minimum(np.append(feeds, len(t.raw))[np.searchsorted(feeds, begin)], t.offsets[row + 1])
    letters = np.zeros(len(t.raw) + 1, dtype=np.int64)
    np.cumsum(~t.space, out=letters[1:])
    full = (letters[end] - letters[begin]) > 0
    begin, end, row = begin[full], end[full], row[full]
    n_lines = np.bincount(row, minlength=t.n)
    keys = np.unique(per_row(t.span_hashes(begin, end), row), return_index=True)[1]
    n_dup = n_lines - np.bincount(row[keys], minlength=t.n)
    at, key = grams(hashes, t.row, 3)
    at = at[repeated(per_row(key, t.row[at]))]
    cover = np.zeros(len(hashes), dtype=bool)
    for i in range(3):
        cover[at + i] = True
    n_repeat = np.bincount(t.row[cover], minlength=t.n)
    return {"n_words": n_words, "word_chars": t.count(lead & ~t.space), "n_symbols": t.count(SYMBOLS[t.raw]),
            "n_dup_lines": n_dup, "n_repeat_words": n_repeat}


def divergence(t: Texts, hashes: np.ndarray, references: list[Reference]) -> tuple[np.ndarray, ...]:
    """(character-class distance, common-word distance) from the nearest
    language, the latter relative to that of a text without a common word too,
    the share of common words and their share in the reference. Nearest is by
    the sum of class distance and relative word distance."""
    classes = _shares(_class_histograms(t))
    by_lang = []
    for r in references:
        shares = _shares(_word_histograms(t, hashes, r.words))
        w = jensen_shannon(shares, r.shares)
        none = np.zeros((1, len(r.shares)))
        none[0, -1] = 1
        by_lang.append((jensen_shannon(classes, r.classes), w, w / jensen_shannon(none, r.shares)[0],
                        shares[:, :-1].sum(axis=1), np.full(t.n, 1 - r.shares[-1])))
    c, w, relative, common, expected = (np.array(x) for x in zip(*by_lang))
    at = np.argmin(c + relative, axis=0), np.arange(t.n)
    return c[at], w[at], relative[at], common[at], expected[at]


SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, class_distance double, word_distance double")


@dataclass
class Rules:
    """Greatest distances from the nearest language that pass, and the guards
    below which a text is too short for the method to judge."""
    max_class: float = 0.28
    max_word: float = 0.52
    max_relative: float = 0.9
    min_coverage: float = 1 / 3
    min_common: int = 14
    min_words: int = 50
    min_chars: int = 200


def verdicts(t: Texts, references: list[Reference], rules: Rules) -> dict[str, np.ndarray]:
    hashes = t.hashes()
    out = base_counts(t, hashes)
    failed = (out["n_words"] < 50) | (100 * out["n_repeat_words"] > 50 * out["n_words"])
    c, w, relative, common, expected = divergence(t, hashes, references) if references else np.zeros((5, t.n))
    few = (relative > rules.max_relative) & (common < rules.min_coverage * expected) & (out["n_words"] * expected >= rules.min_common)
    judged = (out["n_words"] >= rules.min_words) & (t.count((t.raw & 0xC0) != 0x80) >= rules.min_chars)
    out = {k: v.astype(np.int64) for k, v in out.items()}
    return out | {"base_failed": failed, "kept": ~failed & ~(judged & ((c > rules.max_class) | (w > rules.max_word) | few)),
                  "class_distance": c, "word_distance": w}


def quality(docs: DataFrame, references: list[Reference], rules: Rules = Rules(), id_column: str = "doc_id") -> DataFrame:
    """Counts, verdict and distances of every row of ``docs`` (``id_column``, text)."""
    id_type = docs.schema[id_column].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, t in texts(batch.column(1)):
                found = verdicts(t, references, rules)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, t.n), *map(pa.array, found.values())], [id_column, *found])

    return docs.select(id_column, "text").mapInArrow(judge, f"{id_column} {id_type}, {SCHEMA}")


def keep(docs: DataFrame, references: list[Reference], rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` (any columns, with text) that pass."""
    at = docs.columns.index("text")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, t in texts(batch.column(at)):
                yield batch.slice(begin, t.n).filter(pa.array(verdicts(t, references, rules)["kept"]))

    return docs.mapInArrow(judge, docs.schema)
