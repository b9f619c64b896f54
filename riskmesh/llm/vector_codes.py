"""Vector code compression: each vector becomes one small code a part, the index
of the nearest entry of that part's codebook, found in a GNAT over the entries.

1. Components become integers, floor(4096 * x); a vector is cut into ``parts``
   equal parts. A codebook starts as that part of the first vectors by id.
2. A round assigns every part to its nearest entry (squared Euclidean distance,
   ties to the lower index) and replaces an entry by the floor of the mean of its
   parts; an entry without parts stays. Tasks add up their own parts and send one
   row an entry and component; Spark adds these, and only codebooks (bounded by
   parts, entries and dimension) come to the driver and go out with the next round.
3. A last pass writes code and error of each vector; errors are added by label.

GNAT: a node takes a few split points far from each other; every other entry goes
below its nearest split point, and for each pair (split point, child) the node
stores the range of distances from the one to the entries of the other. A query
measures a split point, and by the triangle inequality every child whose range is
farther than the best distance so far is left out whole. Roots are rounded
outwards and a child only goes when its bound is strictly above the best, so ties
are always measured; measured distances are integers and compared as such. A whole
batch of queries walks the tree at once.

Defined cases: a null vector, or one with a null or non-finite component, is
dropped; other vectors are cut to no length: shorter ones are filled up with zeros
to the longest, and that to a multiple of ``parts``. Repeated rows and ids are
each returned; a null id sorts last; null labels are one label. Fewer vectors than
entries give smaller codebooks; an empty table gives no rows. Components beyond
2**27 are computed with Python's integers, and an error beyond a long is the
largest long. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmesh.llm.shared import bounded_broadcast, written

SCALE = 4096
SAFE = 1 << 27          # components below this: distances over a part fit into int64
LONG = (1 << 63) - 1
LIMB = 32
MARGIN = 1e-12          # far above the rounding of a root and a difference
BROADCAST_ROWS = 2_000_000


def _roots(squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds below and above the square roots."""
    if squares.dtype == object:
        low = np.array([math.isqrt(v) for v in squares.ravel()], dtype=object).reshape(squares.shape)
        return low, low + 1
    root = np.sqrt(squares.astype(np.float64))
    return root * (1 - MARGIN), root * (1 + MARGIN)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a - b) ** 2).sum(axis=-1)


class Gnat:
    """Geometric near-neighbour access tree over the rows of ``entries``
    (integers). ``within`` are the row numbers below this node."""

    def __init__(self, entries: np.ndarray, degree: int = 4, within: np.ndarray | None = None):
        self.entries = entries
        within = np.arange(len(entries)) if within is None else within
        self.splits = self._far_apart(within, degree)
        rest = within[~np.isin(within, self.splits)]
        to = np.array([_squares(entries[rest], entries[s]) for s in self.splits]).reshape(len(self.splits), len(rest))
        child = np.argmin(to, axis=0) if len(rest) else np.zeros(0, dtype=np.int64)
        groups = [rest[child == j] for j in range(len(self.splits))]
        self.children = [Gnat(entries, degree, g) if len(g) else None for g in groups]
        # near[i][j], far[i][j]: distances from split i to child j, its own split point included unless i == j
        self.near = [[None] * len(self.splits) for _ in self.splits]
        self.far = [[None] * len(self.splits) for _ in self.splits]
        for i, s in enumerate(self.splits):
            for j, g in enumerate(groups):
                members = g if i == j else np.append(g, self.splits[j])
                if len(members):
                    low, high = _roots(_squares(entries[members], entries[s]))
                    self.near[i][j], self.far[i][j] = min(low), max(high)

    def _far_apart(self, within: np.ndarray, degree: int) -> list[int]:
        splits = [int(within[0])]
        least = _squares(self.entries[within], self.entries[splits[0]])
        while len(splits) < min(degree, len(within)):
            for s in splits:
                least[within == s] = -1
            splits.append(int(within[int(np.argmax(least))]))
            least = np.minimum(least, _squares(self.entries[within], self.entries[splits[-1]]))
        return splits

    def search(self, queries: np.ndarray, at: np.ndarray, best: np.ndarray, which: np.ndarray) -> int:
        """Lower ``best`` (squared distances) and ``which`` (entries) of the
        queries ``at`` by what is below this node; returns distances measured."""
        k, measured = len(self.splits), 0
        out = np.zeros((len(at), k), dtype=bool)      # children left out
        for i, s in enumerate(self.splits):
            here = np.flatnonzero(~out[:, i])
            if not len(here):
                continue
            q = at[here]
            d = _squares(queries[q], self.entries[s])
            measured += len(q)
            better = (d < best[q]) | ((d == best[q]) & (s < which[q]))
            best[q[better]], which[q[better]] = d[better], s
            low, high = _roots(d)
            limit = _roots(best[q])[1]
            for j in range(k):
                if self.near[i][j] is None or (j < i and self.children[j] is None):
                    continue
                gone = (low - self.far[i][j] > limit) | (self.near[i][j] - high > limit)
                out[here, j] |= gone.astype(bool)
        for j, child in enumerate(self.children):
            if child is not None:
                rest = at[~out[:, j]]
                if len(rest):
                    measured += child.search(queries, rest, best, which)
        return measured


class Codebook:
    """Entries of one part, searched by a tree."""

    def __init__(self, entries: list[list[int]]):
        self.exact = np.array(entries, dtype=object).reshape(len(entries), -1)
        self.small = all(abs(v) < SAFE for entry in entries for v in entry)
        self.trees: dict = {}

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of every query row; ties to the lower entry.
        In int64 where everything fits, else with Python's integers."""
        kind = np.int64 if self.small and queries.dtype == np.int64 else object
        if kind not in self.trees:
            self.trees[kind] = Gnat(self.exact.astype(kind))
        tree, queries = self.trees[kind], queries.astype(kind, copy=False)
        # every query starts from one measured entry, so that each walk has a bound
        which = np.zeros(len(queries), dtype=np.int64)
        best = _squares(queries, tree.entries[0])
        tree.search(queries, np.arange(len(queries)), best, which)
        return which, best


def _integers(column: pa.Array, width: int) -> np.ndarray:
    """floor(4096 * x) of list rows, filled up with zeros to ``width``."""
    lengths = np.asarray(column.value_lengths()).astype(np.int64)
    flat = np.asarray(column.flatten()).astype(np.float64)
    if np.abs(flat).max(initial=0) * SCALE < SAFE:
        flat = np.floor(flat * SCALE).astype(np.int64)
    else:
        flat = np.array([int(v) * SCALE if abs(v) >= 2.0**53 else math.floor(v * SCALE) for v in flat.tolist()], dtype=object)
    if (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width), dtype=flat.dtype)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _assign(books: list[Codebook], values: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per part (the vectors' parts, entry, squared distance)."""
    width = values.shape[1] // len(books)
    for p, book in enumerate(books):
        x = values[:, p * width: (p + 1) * width]
        yield x, *book.nearest(x)


def _summing(codebooks, width: int):
    """(part, entry, position, limb, value): the components' sums of each entry's
    parts in limbs of 32 bits, and at position -1 how many parts it has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Codebook(b) for b in codebooks]
        sums: dict[tuple[int, int, int], int] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            for p, (x, entry, _) in enumerate(_assign(books, _integers(batch.column(0), width))):
                for e in np.unique(entry).tolist():
                    mine = x[entry == e]
                    for i, v in enumerate([len(mine), *mine.sum(axis=0).tolist()]):
                        sums[p, e, i - 1] = sums.get((p, e, i - 1), 0) + int(v)
        rows = []
        for (p, e, i), v in sums.items():
            sign, v, limb = (-1 if v < 0 else 1), abs(v), 0
            while v:
                rows.append((p, e, i, limb, sign * (v & ((1 << LIMB) - 1))))
                v, limb = v >> LIMB, limb + 1
        for a in range(0, len(rows), 10_000):
            columns = list(zip(*rows[a: a + 10_000]))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()) for c in columns[:4]] + [pa.array(columns[4], pa.int64())],
                                             ["part", "entry", "position", "limb", "value"])
    return run


def _coding(codebooks, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Codebook(b) for b in codebooks]
        for batch in batches:
            if not batch.num_rows:
                continue
            entries, error = [], 0
            for _, entry, d in _assign(books, _integers(batch.column(2), width)):
                entries.append(entry)
                error = error + d.astype(object)
            codes = np.array(entries).T
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(["".join(f"{c:02x}" for c in row) for row in codes.tolist()]),
                 pa.array([min(v, LONG) for v in error.tolist()], pa.int64())], ["id", "label", "code", "error"])
    return run


def kept_vectors(vectors: DataFrame, vector_column: str = "embedding") -> DataFrame:
    """Rows whose vector is there and has finite components only."""
    x = F.col(vector_column)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return vectors.where(x.isNotNull() & finite)


def train_codebooks(kept: DataFrame, parts: int, entries: int, rounds: int) -> tuple[list, int]:
    """(codebooks[part][entry][position], width of a vector) of ``kept`` (id, vector)."""
    longest = kept.agg(F.max(F.size("vector")).alias("n")).first()["n"] or 0
    width = -(-longest // parts) * parts
    first = kept.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector")
    start = _integers(pa.array([r["vector"] for r in first.collect()], pa.list_(pa.float64())), width) if width else np.zeros((0, 0))
    step = width // parts
    books = [[[int(v) for v in row[p * step: (p + 1) * step]] for row in start] for p in range(parts)]
    for _ in range(rounds if width else 0):
        sums = kept.select("vector").mapInArrow(_summing(books, width), "part int, entry int, position int, limb int, value long") \
            .groupBy("part", "entry", "position", "limb").agg(F.sum("value").alias("value"))
        total: dict[tuple[int, int, int], int] = {}
        for r in sums.collect():  # one row a codebook component and limb
            at = (r["part"], r["entry"], r["position"])
            total[at] = total.get(at, 0) + (r["value"] << (LIMB * r["limb"]))
        for (p, e, i), n in total.items():
            if i < 0:
                books[p][e] = [total.get((p, e, j), 0) // n for j in range(step)]
    return books, width


def compress(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, id_column: str = "vec_id",
             vector_column: str = "embedding", label_column: str = "label") -> DataFrame:
    """Per kept row: ``id_column``, ``code`` (two hex digits a part), ``error``
    (squared distance to the entries), ``label_error`` (added over the rows of its
    label), ``codebooks_sha256``, and the label as ``label``."""
    if not 0 < entries <= 256:
        raise ValueError("a code is one byte a part: 1 to 256 entries")
    kept = kept_vectors(vectors, vector_column).select(F.col(id_column).alias("id"), F.col(label_column).alias("label"),
                                                       F.col(vector_column).alias("vector"))
    books, width = train_codebooks(kept, parts, entries, rounds)
    digest = hashlib.sha256(",".join(str(v) for book in books for entry in book for v in entry).encode()).hexdigest()
    id_type, label_type = (kept.schema[c].dataType.simpleString() for c in ("id", "label"))
    schema = f"id {id_type}, label {label_type}, code string, error long"
    if width:
        coded = kept.mapInArrow(_coding(books, width), schema)
    else:  # no vectors, or only empty ones
        coded = kept.select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    coded = written(coded, "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG).cast("decimal(38,0)")).cast("long")
    labels = written(coded.groupBy(F.col("label").alias("_label")).agg(total.alias("label_error")), "label-errors")
    out = coded.join(bounded_broadcast(labels, BROADCAST_ROWS), F.col("label").eqNullSafe(F.col("_label")))
    return out.select(F.col("id").alias(id_column), "code", "error", "label_error",
                      F.lit(digest).alias("codebooks_sha256"), F.col("label").alias("label"))
