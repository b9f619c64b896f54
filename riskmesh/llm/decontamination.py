"""Benchmark decontamination by CGK embedding.

A passage is a sequence of words (lower case, without punctuation). A document
contains an item of n words if some stretch of it is within
``floor(max_edits * n)`` word edits of the item.

CGK embedding: a random walk reads a sequence, staying at a symbol or moving on
by a random bit of (step, symbol). Walks with the same bits over two sequences
fall into step again after an edit, so the symbols they output differ in few
steps: edit distance has become Hamming distance. Sampling some steps of a walk
gives a key; ``walks`` walks with ``samples`` keys of ``width`` steps each reach
the target recall (see ``expected_recall``). Item keys are a table, window keys
are looked up in it, and every hit is verified by exact edit distance.

Windows are item-sized and start at every word that can begin a match: a stretch
within k edits keeps two of any k + 2 words of the item, at most k places off,
so starts that do not see two of some item's k + 2 rarest words near their
places are left out without loss.

Items come to the driver in blocks of ``block_items`` (each block is one pass
over the documents), so what tasks hold is bounded for any benchmark.

Defined cases: null or empty texts and items match nothing; items of fewer than
``min_words`` words are too short to tell and match nothing; repeated rows and
repeated items each give their own pairs; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmesh.llm.words import mix, texts

# anything of ASCII but letters and digits parts words
SEPARATORS = np.ones(256, dtype=bool)
SEPARATORS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


class Embedding:
    """The walks, and the steps that each key samples, for items by length class."""

    def __init__(self, walks: int = 6, samples: int = 6, width: int = 3, seed: int = 11):
        self.walks, self.samples, self.width, self.seed = walks, samples, width, seed

    @staticmethod
    def length_class(n: int) -> int:
        return int(2 * np.log2(n) + 1e-9)

    def steps(self, length_class: int) -> int:
        """Steps that stay inside the shortest item of the class (a walk moves half a word a step)."""
        return max(self.width, int(1.6 * 2 ** (length_class / 2)))

    def plan(self, classes: list[int], walk: int) -> dict[int, list[int]]:
        """step -> numbers of the keys (class index * samples + sample) that read it, in order."""
        out: dict[int, list[int]] = {}
        for i, c in enumerate(classes):
            rng = np.random.default_rng((self.seed, walk, c))
            for s in range(self.samples):
                for step in rng.choice(self.steps(c), self.width, replace=False):
                    out.setdefault(int(step), []).append(i * self.samples + s)
        return out

    def keys(self, symbols: np.ndarray, start: np.ndarray, end: np.ndarray, classes: list[int], walk: int) -> np.ndarray:
        """(len(classes) * samples, len(start)) keys of the sequences symbols[start:end]."""
        plan = self.plan(classes, walk)
        keys = np.zeros((len(classes) * self.samples, len(start)), dtype=np.uint64)
        at, last = start.copy(), len(symbols) - 1
        bits = None
        for step in range(max(plan, default=-1) + 1):
            if step % 64 == 0:
                salt = mix(np.array([self.seed * 1_000_003 + walk * 1009 + step // 64], dtype=np.uint64))
                bits = mix(symbols ^ salt)
            here, inside = np.minimum(at, last), at < end
            if step in plan:
                seen = np.where(inside, symbols[here], np.uint64(0))
                for k in plan[step]:
                    keys[k] = keys[k] * np.uint64(0x9E3779B97F4A7C15) + seen
            at += ((bits[here] >> np.uint64(step % 64)) & np.uint64(1)).astype(np.int64)
        return keys


def edit_match(item: np.ndarray, words: np.ndarray, most: int) -> tuple[int, int] | None:
    """(distance, end) of the stretch of ``words`` nearest to ``item``, or None
    if its distance is above ``most``. Exact dynamic programme, row by row."""
    m = len(words)
    row = np.zeros(m + 1, dtype=np.int64)  # a stretch may start anywhere
    place = np.arange(m + 1)
    for i, w in enumerate(item):
        new = np.empty_like(row)
        new[0] = i + 1
        new[1:] = np.minimum(row[:-1] + (words != w), row[1:] + 1)
        new = np.minimum.accumulate(new - place) + place  # insertions
        if new.min() > most:
            return None
        row = new
    end = int(row.argmin())
    return (int(row[end]), end) if row[end] <= most else None


class Index:
    """The keys of one block of items."""

    def __init__(self, items: list[np.ndarray], lengths: list[np.ndarray], max_edits: float, embedding: Embedding):
        self.items, self.embedding = items, embedding
        self.size = np.array([len(x) for x in items])
        self.most = np.floor(max_edits * self.size + 1e-9).astype(np.int64)
        length_class = np.array([embedding.length_class(n) for n in self.size])
        self.classes = sorted(set(length_class.tolist()))
        flat = np.concatenate(items)
        first = np.cumsum(self.size) - self.size
        self.tables = []  # per walk and key: sorted keys and their items
        for walk in range(embedding.walks):
            keys = embedding.keys(flat, first, first + self.size, self.classes, walk)
            tables = []
            for i, c in enumerate(self.classes):
                own = np.flatnonzero(length_class == c)
                for s in range(embedding.samples):
                    k = keys[i * embedding.samples + s, own]
                    order = np.argsort(k, kind="stable")
                    tables.append((k[order], own[order]))
            self.tables.append(tables)
        # the k + 2 rarest words of each item (in few items, and long), by word: item, least and largest
        # distance of a hit behind the start of a match
        word, code, count = np.unique(flat, return_inverse=True, return_counts=True)
        picks = []
        for i, (a, n) in enumerate(zip(first, self.size)):
            rare = np.lexsort((-lengths[i], count[code[a: a + n]]))[: self.most[i] + 2]
            picks.append((flat[a + rare], np.full(len(rare), i), rare - self.most[i], rare + self.most[i]))
        pick_word, item, low, high = (np.concatenate(x) for x in zip(*picks))
        order = np.argsort(pick_word, kind="stable")
        self.rare, self.rare_first = np.unique(pick_word[order], return_index=True)
        self.rare_first = np.append(self.rare_first, len(order))
        self.picks = item[order], low[order], high[order]
        self.length_class = length_class

    def starts(self, symbols: np.ndarray, row: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
        """Word positions at which a match may begin, by length class."""
        at = np.minimum(np.searchsorted(self.rare, symbols), len(self.rare) - 1)
        hit = np.flatnonzero(self.rare[at] == symbols)
        none = [np.zeros(0, dtype=np.int64)] * len(self.classes)
        if len(hit) < 2:
            return none
        # each hit opens, for each of its items, a stretch of possible starts
        n = np.diff(self.rare_first)[at[hit]]
        pick = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.rare_first[at[hit]], n)
        p = np.repeat(hit, n)
        item, low, high = (x[pick] for x in self.picks)
        begin, end = first[row[p]], first[row[p] + 1]
        a = np.minimum(np.maximum(p - high, begin), end - 1)
        b = np.minimum(np.maximum(p - low, begin), end - 1) + 1
        # starts that lie in two stretches of one item
        event = np.concatenate([a, b])
        of = np.concatenate([item, item])
        step = np.concatenate([np.ones(len(a), dtype=np.int64), np.full(len(b), -1)])
        order = np.lexsort((event, of))
        depth = np.cumsum(step[order])
        twice = np.flatnonzero(depth[:-1] >= 2)
        a, b, of = event[order][twice], event[order][twice + 1], of[order][twice]
        out = []
        for c in self.classes:
            own = self.length_class[of] == c
            delta = np.zeros(len(symbols) + 1, dtype=np.int64)
            np.add.at(delta, a[own], 1)
            np.add.at(delta, b[own], -1)
            out.append(np.flatnonzero(np.cumsum(delta[:-1]) > 0))
        return out

    def search(self, symbols: np.ndarray, row: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(row, item, distance, first word) of the best match of every row and item."""
        pairs = []
        for c, start in enumerate(self.starts(symbols, row, first) if len(symbols) else []):
            if not len(start):
                continue
            end = first[row[start] + 1]
            for walk, tables in enumerate(self.tables):
                keys = self.embedding.keys(symbols, start, end, self.classes[c: c + 1], walk)
                for k, (table, items) in zip(keys, tables[c * self.embedding.samples: (c + 1) * self.embedding.samples]):
                    low = np.searchsorted(table, k, side="left")
                    count = np.searchsorted(table, k, side="right") - low
                    hit = np.flatnonzero(count)
                    if len(hit):
                        n = count[hit]
                        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                        pairs.append(np.stack([np.repeat(start[hit], n), items[np.repeat(low[hit], n) + within]]))
        best: dict[tuple[int, int], tuple[int, int]] = {}
        done: dict[tuple[int, int], int] = {}
        if pairs:
            both = np.unique(np.concatenate(pairs, axis=1), axis=1)
            for w, i in zip(*(x.tolist() for x in both)):
                r, s = int(row[w]), w
                n, most = int(self.size[i]), int(self.most[i])
                # windows arrive in order: one verification covers the starts up to `most` words on
                if done.get((r, i), -1) >= s:
                    continue
                low, high = max(s - most, int(first[r])), min(s + n + 2 * most, int(first[r + 1]))
                found = edit_match(self.items[i], symbols[low:high], most)
                if found:
                    done[r, i] = s + most
                    old = best.get((r, i))
                    if old is None or found[0] < old[0]:
                        best[r, i] = (found[0], max(low + found[1] - n, low) - int(first[r]))
        return [(r, i, d, at) for (r, i), (d, at) in sorted(best.items())]


def expected_recall(embedding: Embedding, n: int = 40, edits: int = 4, trials: int = 400, seed: int = 3) -> float:
    """Share of random sequences of ``n`` words that meet a copy with ``edits``
    random edits in some key."""
    rng = np.random.default_rng(seed)
    c = [embedding.length_class(n)]
    found = 0
    for _ in range(trials):
        a = mix(rng.integers(1, 1 << 62, n).astype(np.uint64))
        b = a.tolist()
        for _ in range(edits):
            at, kind = int(rng.integers(len(b))), rng.integers(3)
            if kind == 0:
                del b[at]
            elif kind == 1:
                b.insert(at, int(rng.integers(1, 1 << 62)))
            else:
                b[at] = int(rng.integers(1, 1 << 62))
        both = np.concatenate([a, np.array(b, dtype=np.uint64)])
        first = np.array([0, n])
        found += any((k[0] == k[1]) for w in range(embedding.walks)
                     for k in embedding.keys(both, first, np.array([n, n + len(b)]), c, w))
    return found / trials


def _blocks(items: DataFrame, item_column: str, min_words: int, block_items: int):
    """(ids, word hashes, word lengths) of the items, ``block_items`` at a time."""
    rows = items.where("text is not null").select(item_column, "text").orderBy(item_column, "text").toLocalIterator()
    while block := list(islice(rows, block_items)):
        ids, words, lengths = [], [], []
        for begin, t in texts(pa.array([r["text"] for r in block], pa.string()), lower=True, separators=SEPARATORS):
            hashes = t.hashes()
            for i in range(t.n):
                own = slice(t.first[i], t.first[i + 1])
                if t.first[i + 1] - t.first[i] >= min_words:
                    ids.append(block[begin + i][item_column])
                    words.append(hashes[own])
                    lengths.append((t.ends - t.starts)[own])
        if ids:
            yield ids, words, lengths


def _searcher(words, lengths, max_edits: float, embedding: Embedding, column: int):
    """Function of a batch: (row of the batch, item, distance, first word) of its matches."""
    index = Index(words, lengths, max_edits, embedding)

    def search(batch: pa.RecordBatch) -> list[tuple[int, int, int, int]]:
        return [(begin + r, i, d, at) for begin, t in texts(batch.column(column), lower=True, separators=SEPARATORS)
                for r, i, d, at in index.search(t.hashes(), t.row, t.first)]
    return search


def contaminated(docs: DataFrame, items: DataFrame, max_edits: float = 0.2, min_words: int = 6, id_column: str = "doc_id", item_column: str = "item_id",
                 block_items: int = 5000, embedding: Embedding | None = None) -> DataFrame:
    """(``id_column``, ``item_column``, distance, item_words, first_word) for
    every row of ``docs`` (``id_column``, text) and item of ``items``
    (``item_column``, text) that it contains."""
    embedding = embedding or Embedding()
    id_type, item_type = docs.schema[id_column].dataType.simpleString(), items.schema[item_column].dataType.simpleString()
    schema = f"{id_column} {id_type}, {item_column} {item_type}, distance long, item_words long, first_word long"
    out = None
    for ids, words, lengths in _blocks(items, item_column, min_words, block_items):

        def run(batches: Iterator[pa.RecordBatch], words=words, lengths=lengths) -> Iterator[pa.RecordBatch]:
            search = _searcher(words, lengths, max_edits, embedding, 1)
            for batch in batches:
                found = search(batch)
                if found:
                    r, i, d, at = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(r)), pa.array(i, pa.int64()), pa.array(d, pa.int64()),
                         pa.array([len(words[x]) for x in i], pa.int64()), pa.array(at, pa.int64())],
                        [id_column, "_item", "distance", "item_words", "first_word"])

        found = docs.select(id_column, "text").mapInArrow(run, f"{id_column} {id_type}, _item long, distance long, item_words long, first_word long")
        names = docs.sparkSession.createDataFrame(list(enumerate(ids)), f"_item long, {item_column} {item_type}")  # block_items rows
        part = found.join(F.broadcast(names), "_item").select(id_column, item_column, "distance", "item_words", "first_word")
        out = part if out is None else out.unionAll(part)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def clean(docs: DataFrame, items: DataFrame, max_edits: float = 0.2, min_words: int = 6, item_column: str = "item_id",
          block_items: int = 5000, embedding: Embedding | None = None) -> DataFrame:
    """The rows of ``docs`` (any columns, with text) that contain no item."""
    embedding = embedding or Embedding()
    at = docs.columns.index("text")
    for _, words, lengths in _blocks(items, item_column, min_words, block_items):

        def run(batches: Iterator[pa.RecordBatch], words=words, lengths=lengths) -> Iterator[pa.RecordBatch]:
            search = _searcher(words, lengths, max_edits, embedding, at)
            for batch in batches:
                stay = np.ones(batch.num_rows, dtype=bool)
                stay[[r for r, *_ in search(batch)]] = False
                yield batch.filter(pa.array(stay))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
