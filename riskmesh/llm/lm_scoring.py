"""Language-model scores of whole texts: a unigram base over words, and the
causal self-attention model of ``attention_lm`` over subword ids.

Texts are read and cut into words and subwords once: the hashes of the words and the
ids of the subwords are written as numbers, and every pass below reads these.
Counts cover all training documents: one pass adds up words (by 64-bit hash) and
subword ids in each task before the shuffle. A second one adds up which class of
subwords follows which subword, again in one bounded array a task: these transitions
are the model's table, and a pass before it counts the neighbours that put subwords
into classes. The attention that is added for longer context is fitted in one pass over
all training documents: each task takes every window of its texts once, from common
start values, and the tasks' weights are averaged by their windows. Only the start
values come from a bounded sample: the training documents whose hash lies below the
bound that leaves about ``sample_docs`` (never more than twice that), and at most
``sample_tokens`` of their tokens. Subword shares come from the counts.

The base needs the count of every word of every text. The most frequent words
(as many count levels as fit into ``table_words``) are a table that every task
has; the rest goes through one join by word, one row per rare word of a text,
so neither the vocabulary nor a frequent word ever lands in one place.

Defined cases: a null or empty text is its end token alone; rows with a null id
count as id ''; repeated rows are scored each; an empty table gives no rows;
without training rows every word is unknown; other columns are not read.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmesh.llm import attention_lm
from riskmesh.llm.shared import written
from riskmesh.llm.words import SLICE_BYTES, Texts, texts

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# fixed value: the split pattern that belongs to byte-level vocabularies of this kind
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END = 0x7E57_E4D0  # key of the end token among word hashes

_encoders: dict[int, tuple] = {}
_known: dict[int, Subwords] = {}


def _encoder(vocabulary: bytes):
    """(tokenizer, bytes of each id) of a vocabulary file's bytes, built once a worker."""
    import tiktoken
    key = hash(vocabulary)
    if key not in _encoders:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        length = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        length[list(ranks.values())] = [len(x) for x in ranks]
        _encoders[key] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), length
    return _encoders[key]


class Places:
    """Where 64-bit hashes stand in a sorted array of different ones: their leading
    bits give the first place that can be theirs, from there it is a few steps."""

    def __init__(self, keys: np.ndarray):
        bits = max(len(keys).bit_length() - 2, 1)
        self.shift, self.n = np.uint64(64 - bits), len(keys)
        self.begin = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << self.shift)
        self.keys = np.append(keys, np.uint64(2**64 - 1))

    def of(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the first key that is not below each hash, whether it is the hash)."""
        at = self.begin.take((hashes >> self.shift).astype(np.int64))
        behind = np.flatnonzero(self.keys.take(at) < hashes)
        while len(behind):
            at[behind] += 1
            behind = behind[self.keys.take(at[behind]) < hashes[behind]]
        return at, (self.keys.take(at) == hashes) & (at < self.n)


class Subwords:
    """Subword ids of words, each distinct word encoded once while it is
    remembered (as arrays: sorted hashes, place and number of ids)."""

    def __init__(self, vocabulary: bytes, remember: int = 1_000_000):
        encoder, self.length = _encoder(vocabulary)
        self.encode, self.remember = encoder.encode_ordinary, remember
        self._clear()

    def _clear(self) -> None:
        self.places = Places(np.zeros(0, dtype=np.uint64))
        self.place = self.size = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.int32)

    def _learn(self, keys: np.ndarray, words: list[bytes]) -> None:
        """``keys`` are sorted and new. All words are encoded in one text, as the
        tokenizer parts it at the blanks; the ids' byte lengths give them back
        to the words (one by one, should a piece have crossed a blank)."""
        ids = np.array(self.encode(b"".join(b" " + w for w in words).decode("utf-8", "replace")), dtype=np.int32)
        ends, bounds = np.cumsum(self.length[ids]), np.cumsum([len(w) + 1 for w in words])
        last = np.minimum(np.searchsorted(ends, bounds), len(ends) - 1)
        if np.array_equal(ends[last], bounds):
            size = np.diff(last, prepend=-1)
        else:
            parts = [self.encode(" " + w.decode("utf-8", "replace")) for w in words]
            size = np.array([len(x) for x in parts])
            ids = np.array([x for part in parts for x in part], dtype=np.int32)
        known = self.places.keys[:-1]
        at = np.searchsorted(known, keys)
        self.place = np.insert(self.place, at, len(self.ids) + np.cumsum(size) - size)
        self.size = np.insert(self.size, at, size)
        self.places = Places(np.insert(known, at, keys))
        self.ids = np.concatenate([self.ids, ids])

    def of(self, t: Texts, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words of ``t``, how many ids each word has)."""
        if not len(hashes):
            return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
        if self.places.n > self.remember:
            self._clear()
        at, there = self.places.of(hashes)
        if not there.all():
            new = np.flatnonzero(~there)
            unique, word = np.unique(hashes[new], return_index=True)
            word, raw = new[word], t.raw.tobytes()
            self._learn(unique, [raw[a:b] for a, b in zip(t.starts[word].tolist(), t.ends[word].tolist())])
            at, _ = self.places.of(hashes)
        n = self.size.take(at)
        return self.ids.take(np.repeat(self.place.take(at) - (np.cumsum(n) - n), n) + np.arange(n.sum())), n


def _laid(subwords: Subwords, t: Texts, end: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(subwords of all texts, each behind with the end; where each text begins)."""
    ids, sizes = subwords.of(t, hashes)
    first = np.r_[0, np.cumsum(np.bincount(t.row, weights=sizes, minlength=t.n).astype(np.int64) + 1)]
    flat = np.full(first[-1], end, dtype=np.int64)
    inside = np.ones(len(flat), dtype=bool)
    inside[first[1:] - 1] = False
    flat[inside] = ids
    return flat, first


def _width(end: int) -> type:
    """The numbers that subword ids are written as."""
    return np.uint16 if end < 1 << 16 else np.int32


def _tokenizer(vocabulary: bytes, end: int, id_column: str):
    """Per text: its bytes, the hashes of its words and its subwords with the end, as numbers in binary."""
    def numbers(values: np.ndarray, first: np.ndarray) -> pa.Array:
        where = (first * values.itemsize).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(where) - 1, [None, pa.py_buffer(where.tobytes()), pa.py_buffer(values.tobytes())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        subwords = _known.setdefault(hash(vocabulary), Subwords(vocabulary))   # a worker's tasks share what is encoded
        for batch in batches:
            for begin, t in texts(batch.column(2), lower=True):
                hashes = t.hashes()
                flat, first = _laid(subwords, t, end, hashes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, t.n), batch.column(1).slice(begin, t.n), pa.array(np.diff(t.offsets).astype(np.int64)),
                     numbers(hashes, t.first), numbers(flat.astype(_width(end)), first)], [id_column, "held_out", "n_bytes", "words", "ids"])
    return run


def _numbers(column: pa.Array, dtype: type) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of all rows, where each row's begin, plus the total)."""
    column = column.cast(pa.large_binary())
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0]: offsets[-1]].view(dtype), (offsets - offsets[0]) // np.dtype(dtype).itemsize


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of about ``SLICE_BYTES`` of text (column n_bytes)."""
    edges, begin = np.r_[0, np.cumsum(np.asarray(batch.column("n_bytes")))], 0
    while begin < batch.num_rows:
        end = min(max(int(np.searchsorted(edges, edges[begin] + SLICE_BYTES, side="right")) - 1, begin + 1), batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end


def _read(batches: Iterator[pa.RecordBatch], end: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(subwords, where each text begins) of pieces of written texts."""
    for batch in batches:
        for piece in _pieces(batch):
            flat, first = _numbers(piece.column("ids"), _width(end))
            yield flat.astype(np.int64), first


def _counter(end: int):
    """(kind, key, n) of one task: words by hash (0), subwords by id (1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _known.clear()                                      # a worker from the pass before has no more use for them
        ids = np.zeros(end + 1, dtype=np.int64)
        keys, counts, waiting = [], [], 0

        def merge():
            key, code = np.unique(np.concatenate(keys), return_inverse=True)
            keys[:], counts[:] = [key], [np.bincount(code, weights=np.concatenate(counts), minlength=len(key))]

        for batch in batches:
            for piece in _pieces(batch):
                ids += np.bincount(_numbers(piece.column("ids"), _width(end))[0], minlength=end + 1)
                key, n = np.unique(_numbers(piece.column("words"), np.uint64)[0], return_counts=True)
                keys.append(np.append(key, np.uint64(END)))
                counts.append(np.append(n, piece.num_rows))
                waiting += len(key)
                if waiting > 1_000_000:
                    merge()
                    waiting = 0
        if keys:
            merge()
            some = np.flatnonzero(ids)
            for kind, key, n in ((0, keys[0].view(np.int64), counts[0]), (1, some, ids[some])):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), kind, dtype=np.int32)), pa.array(key.astype(np.int64)),
                                                  pa.array(n.astype(np.int64))], ["kind", "key", "n"])
    return run


def _neighbour(end: int, code: np.ndarray, n_codes: int):
    """(key, n) of one task: how often a code stands before (key = (subword * 2) * codes + code)
    and behind (key = (subword * 2 + 1) * codes + code) a subword."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(code) * 2 * n_codes, dtype=np.int64)
        for flat, _ in _read(batches, end):
            before = np.r_[end, flat[:-1]]
            for key in (flat * 2 * n_codes + code[before], (before * 2 + 1) * n_codes + code[flat]):
                np.add.at(total, key, 1)
        some = np.flatnonzero(total)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["key", "n"])
    return run


def _fitter(model: attention_lm.Model):
    """(key, w) of one task: its weights times its windows, the windows as key -1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit = attention_lm.Fit(model)
        for flat, first in _read(batches, model.begin):
            fit.texts(flat, first)
        if fit.windows:
            w = fit.weights() * fit.windows
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(w))), pa.array(np.r_[float(fit.windows), w])], ["key", "w"])
    return run


def _follower(end: int, inputs: np.ndarray, classes: np.ndarray, n_classes: int, cells: int):
    """(key, n) of one task: how often a class follows an input row (key = row * classes + class)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, dtype=np.int64)
        for flat, _ in _read(batches, end):                 # the end of a text is the begin of the next one
            before = np.r_[end, flat[:-1]]
            total += np.bincount(inputs[before].astype(np.int64) * n_classes + classes[flat], minlength=cells)
        some = np.flatnonzero(total)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["key", "n"])
    return run


def _scorer(model: attention_lm.Model, table: tuple[np.ndarray, np.ndarray], id_column: str):
    """Per text: tokens, known tokens and ln base of the words in the table, hashes of the other words, ln model score."""
    keys, values = table

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, behind, tables = Places(keys), np.append(values, 0.0), model.tables()
        for batch in batches:
            for piece in _pieces(batch):
                hashes, words = _numbers(piece.column("words"), np.uint64)
                flat, first = _numbers(piece.column("ids"), _width(model.begin))
                ln = attention_lm.score(model, tables, flat.astype(np.int64), first)
                at, inside = places.of(hashes)
                n, row = piece.num_rows, np.repeat(np.arange(piece.num_rows), np.diff(words))
                known = np.bincount(row[inside], minlength=n)
                base = np.bincount(row, weights=np.where(inside, behind.take(at), 0.0), minlength=n)
                rest = ~inside
                tail = np.r_[0, np.cumsum(np.bincount(row[rest], minlength=n))].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(id_column), piece.column("held_out"), pa.array(np.diff(words) + 1), pa.array(known.astype(np.int64)),
                     pa.array(base.astype(np.float64)), pa.ListArray.from_arrays(pa.array(tail), pa.array(hashes[rest].view(np.int64))), pa.array(ln / math.log(10))],
                    [id_column, "held_out", "n_tokens", "known", "base", "tail", "score"])
    return run


def score(docs: DataFrame, held_out: Column, id_column: str = "doc_id", vocabulary_path: str = TOKENIZER, table_words: int = 500_000,
          sample_docs: int = 400, sample_tokens: int = 600_000) -> DataFrame:
    """Per row of ``docs`` (``id_column``, text): held_out, n_tokens, n_known,
    train_tokens, base_score and score (log10). Rows that are ``held_out``
    teach nothing."""
    vocabulary = open(vocabulary_path, "rb").read()  # on the driver; tasks get the bytes
    end = 1 + max(int(line.split()[1]) for line in vocabulary.splitlines())
    rows = docs.select(F.col(id_column), held_out.alias("held_out"), "text")
    id_type = docs.schema[id_column].dataType.simpleString()
    tokens = written(rows.mapInArrow(_tokenizer(vocabulary, end, id_column), f"{id_column} {id_type}, held_out boolean, n_bytes long, words binary, ids binary"), "tokens")
    training = tokens.where(~F.col("held_out"))
    learnt = training.select("n_bytes", "ids")
    # tasks have counted, so another aggregate before the shuffle would only pass their rows on
    counts = written(training.select("n_bytes", "words", "ids").mapInArrow(_counter(end), "kind int, key long, n long")
                     .repartition("kind", "key").groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")
    words = counts.where("kind = 0").select("key", "n")
    whole = words.agg(F.sum("n").alias("N"), F.count("*").alias("V")).first()
    total, distinct = whole["N"] or 0, whole["V"]
    over = total + 0.5 * (distinct + 1)
    # the least count whose words, with all more frequent ones, fit into the table
    levels = words.where("n > 1").groupBy("n").count().orderBy(F.desc("n"))
    least, taken = None, 0
    for r in levels.toLocalIterator():
        taken += r["count"]
        if taken > table_words:
            break
        least = r["n"]
    if least is None:
        keys, values = np.zeros(0, dtype=np.uint64), np.zeros(0)
    else:
        frequent = words.where(F.col("n") >= least).toArrow()
        keys, values = frequent["key"].to_numpy().view(np.uint64), np.log10((frequent["n"].to_numpy() + 0.5) / over)
        order = np.argsort(keys)
        keys, values = keys[order], values[order]
    subcounts = np.zeros(end + 1)
    for r in counts.where("kind = 1").collect():  # at most one row a subword
        subcounts[r["key"]] = r["n"]
    # about sample_docs documents by a bound on their hash: no sort, and no task gathers more than the sample
    texts_in = max((words.where(F.col("key") == END).first() or {"n": 0})["n"], 1)
    near = F.shiftrightunsigned(F.xxhash64(F.lit(2), id_column, "text"), 1) < F.lit(min(int(sample_docs / texts_in * 2**63), 2**63 - 1))
    sample = rows.where(~F.col("held_out") & F.col("text").isNotNull() & near).select("text").limit(2 * sample_docs).toArrow()
    subwords, parts, used = Subwords(vocabulary), [], 0
    for _, t in texts(sample["text"], lower=True):
        ids, sizes = subwords.of(t, t.hashes())
        per = np.bincount(t.row, weights=sizes, minlength=t.n).astype(np.int64)
        for own in np.split(ids, np.cumsum(per)[:-1]):
            if used < sample_tokens:
                parts.append(np.append(own, end)[: sample_tokens - used])
                used += len(parts[-1])
    ids = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)

    def gather(inputs: np.ndarray, classes: np.ndarray, n_rows: int, n_classes: int) -> np.ndarray:
        cells = n_rows * n_classes
        found = learnt.mapInArrow(_follower(end, inputs, classes, n_classes, cells), "key long, n long") \
            .groupBy("key").agg(F.sum("n").alias("n")).toArrow()      # at most one row a cell
        out = np.zeros(cells)
        out[found["key"].to_numpy()] = found["n"].to_numpy()
        return out

    def neighbours(code: np.ndarray, n_codes: int) -> np.ndarray:
        found = learnt.mapInArrow(_neighbour(end, code, n_codes), "key long, n long") \
            .groupBy("key").agg(F.sum("n").alias("n")).toArrow()      # at most one row a cell
        out = np.zeros(len(code) * 2 * n_codes, dtype=np.float32)
        out[found["key"].to_numpy()] = found["n"].to_numpy()
        return out.reshape(len(code), 2 * n_codes)

    model = attention_lm.train(ids.astype(np.int64), np.cumsum([0, *map(len, parts)]), subcounts, end, gather=gather, neighbours=neighbours)
    # from there on every training text is in one step of a task's fit; the tasks' weights are averaged
    fitted = learnt.mapInArrow(_fitter(model), "key long, w double") \
        .groupBy("key").agg(F.sum("w").alias("w")).toArrow()          # one row a weight
    if len(fitted):
        order = np.argsort(fitted["key"].to_numpy())
        w = fitted["w"].to_numpy()[order]
        model = attention_lm.with_weights(model, w[1:] / w[0])
    scored = tokens.mapInArrow(_scorer(model, (keys, values), id_column),
                               f"{id_column} {id_type}, held_out boolean, n_tokens long, known long, base double, tail array<long>, score double")
    scored = written(scored.withColumn("uid", F.monotonically_increasing_id()), "scored")
    rare = scored.select("uid", F.explode("tail").alias("w")).join(words, F.col("w") == F.col("key"), "left") \
        .groupBy("uid").agg(F.count("n").alias("more"), F.sum(F.log10((F.coalesce("n", F.lit(0)) + 0.5) / F.lit(over))).alias("add"))
    end_count = words.where(F.col("key") == END).first()
    end_count = end_count["n"] if end_count else 0
    end_ln = math.log10((end_count + 0.5) / over)
    return scored.drop("tail").join(rare, "uid", "left").select(
        id_column, "held_out", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0)) + (1 if end_count else 0)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("add", F.lit(0.0)) + end_ln).alias("base_score"), "score")
