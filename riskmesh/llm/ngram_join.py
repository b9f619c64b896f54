"""N-gram Jaccard join: which documents share at least ``percent`` of their
distinct word n-grams, and the components these links make.

1. Each text becomes its set of 64-bit n-gram hashes; equal sets are one class
   (thousands of copies cost one row from here on).
2. Prefix filter under one global order. Two sets of that similarity must share
   one of the first n - ceil(t n) + 1 elements of either. The order puts a fixed
   share of the hash space first, twice what a set may miss (a fifth at 90 percent),
   by document frequency (rare first, counted exactly over all classes), and the
   rest after it, so frequencies are counted for that share only.
3. Elements that no class of a similar size has too are dropped from a set, and a
   set that has lost more elements than it may miss is out. The sets that are left
   are counted again, so sets go that only shared a passage with sets that went.
   Classes that share a prefix element (and nearly a size) form neighbourhoods;
   every link lies inside one. Each is joined by a trie over its ordered sets:
   a set walks the trie adding up its overlap once for all sets below a node, and
   leaves a subtree whose remaining lengths cannot reach the required overlap.
   A pair that is already connected is not looked at again, so a hub and its
   thousands of copies cost one walk; links come out as a spanning forest.
   A neighbourhood above ``block_elements`` elements is dealt in pairs of blocks,
   each with the neighbourhood's likeliest hub, so memory stays bounded.

Defined cases: a null or empty text has the empty set, size 0, and links with
nothing; a text with fewer than n words is one element (its whole word
sequence); rows with a null id take part, and their component is the smallest
known id in it (null if there is none); repeated rows are each returned; other
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmesh.llm.shared import bounded_broadcast, components, written
from riskmesh.llm.words import Texts, _spans, grams, mix, texts

PEELS = 2   # rounds of counting among the sets that are left
BROADCAST_ROWS = 1_000_000


def first_part(percent: int) -> int:
    """Hashes below this come first in the order: twice the share of its elements
    that a set may miss, so that sets with half of them unshared are recognised."""
    return min((200 - 2 * percent) * 2**64 // 100, 2**64 - 1)


def gram_sets(t: Texts, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct n-grams, ordered by row and hash."""
    hashes = t.hashes()
    at, key = grams(hashes, t.row, n)
    row = t.row[at]
    few = np.flatnonzero((t.n_words() < n) & (t.n_words() > 0))
    if len(few):
        row = np.concatenate([row, few])
        key = np.concatenate([key, _spans(hashes, t.first[few], t.first[few + 1])])
    order = np.lexsort((key, row))
    row, key = row[order], key[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    return row[new], key[new]


def _least_overlap(n, percent: int):
    """Elements a set of n must share with any partner (n: int or array)."""
    return -((-percent * n) // 100)


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def _summaries(n: int, percent: int, id_column: str):
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, t in texts(batch.column(2), lower=True):
                row, key = gram_sets(t, n)
                first = np.searchsorted(row, np.arange(t.n + 1))
                size = np.diff(first)
                prefix = size - _least_overlap(size, percent) + 1
                head = np.bincount(row[key < np.uint64(first_part(percent))], minlength=t.n)
                keep = np.minimum(np.maximum(head, prefix), size)
                rank = np.arange(len(key)) - first[row]
                kept = key[rank < keep[row]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, t.n), batch.column(1).slice(begin, t.n), pa.array(size.astype(np.int64)),
                     pa.array(_sums(mix(key), first).view(np.int64)), pa.array(_sums(mix(key ^ np.uint64(0x5851F42D4C957F2D)), first).view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(keep)].astype(np.int32)), pa.array(kept.view(np.int64)))],
                    [id_column, "text_hash", "n", "s1", "s2", "head"])
    return summarise


def _full_sets(n: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, t in texts(batch.column(2), lower=True):
                row, key = gram_sets(t, n)
                first = np.searchsorted(row, np.arange(t.n + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(begin, t.n) for i in range(2)] + [pa.ListArray.from_arrays(pa.array(first), pa.array(key.view(np.int64)))],
                    ["hood", "cid", "set"])
    return read


class Trie:
    """Compressed trie over sets given as sorted arrays of small integers."""

    def __init__(self, sets: list[np.ndarray]):
        packed = [s.astype(">u4").tobytes() for s in sets]
        self.order = sorted(range(len(sets)), key=packed.__getitem__)
        self.sets = [sets[i] for i in self.order]
        self.size = np.array([len(s) for s in self.sets])
        # nodes: [first leaf, end leaf, start depth, end depth, children]
        self.root = [0, len(sets), 0, 0, []]
        path = [self.root]
        for i, s in enumerate(self.sets):
            shared = 0
            if i:
                before = self.sets[i - 1]
                k = min(len(s), len(before))
                differ = np.flatnonzero(s[:k] != before[:k])
                shared = int(differ[0]) if len(differ) else k
                while path[-1][2] >= shared and len(path) > 1:
                    path.pop()[1] = i
                top = path[-1]
                if top[3] > shared or (len(path) > 1 and not top[4]):  # split the edge, or a set ends here
                    lower = [top[0], i, shared, top[3], top[4]]
                    top[3], top[4] = shared, [lower]
            leaf = [i, i + 1, path[-1][3], len(s), []]
            path[-1][4].append(leaf)
            path.append(leaf)
        while path:
            path.pop()[1] = len(sets)

    def walk(self, query: np.ndarray, marks: np.ndarray, wanted: np.ndarray, percent: int) -> list[int]:
        """Leaves with ``wanted`` (running count per leaf) whose Jaccard with
        ``query`` reaches ``percent``. ``marks`` is true at the query's elements."""
        found, n = [], len(query)
        todo = [(self.root, 0)]
        while todo:
            node, overlap = todo.pop()
            first, end, start, depth, children = node[:5]
            if wanted[end] == wanted[first]:
                continue
            if depth > start:
                edge = self.sets[first][start:depth]
                overlap += int(np.count_nonzero(marks[edge]))
                rest = n - int(np.searchsorted(query, edge[-1], side="right"))
            else:
                rest = n
            sizes = self.size[first:end]
            small, large = (sizes[0], sizes[0]) if end == first + 1 else (sizes.min(), sizes.max())
            if 100 * large < percent * n or 100 * n < percent * small:
                continue
            if (overlap + min(rest, large - depth)) * (100 + percent) < percent * (n + small):
                continue
            if not children:
                for leaf in range(first, end):  # sets that end here
                    if wanted[leaf + 1] > wanted[leaf] and overlap * (100 + percent) >= percent * (n + self.size[leaf]):
                        found.append(leaf)
            elif len(children) < 8:
                todo += [(c, overlap) for c in children]
            else:  # only children above a wanted leaf
                if len(node) == 5:
                    node.append(np.array([c[0] for c in children]))
                leaves = first + np.flatnonzero(np.diff(wanted[first: end + 1]))
                todo += [(children[c], overlap) for c in np.unique(np.searchsorted(node[5], leaves, side="right") - 1).tolist()]
        return found


def trie_links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of ``sets`` (arrays of distinct hashes)
    with Jaccard of at least ``percent``, as index pairs."""
    values, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(values), dtype=np.int64)
    rank[np.lexsort((values, count))] = np.arange(len(values))
    bounds = np.cumsum([0, *map(len, sets)])
    trie = Trie([np.sort(rank[code[a:b]]) for a, b in zip(bounds[:-1], bounds[1:])])
    m = len(sets)
    # elements of its own bound what a set can share, and how much larger a union must be
    size = trie.size
    own = np.array([np.count_nonzero(count[code[a:b]] == 1) for a, b in zip(bounds[:-1], bounds[1:])])[trie.order]
    shared = size - own
    part, done = np.arange(m), np.zeros(m, dtype=bool)
    marks, out = np.zeros(len(values), dtype=bool), []
    wanted = np.zeros(m + 1, dtype=np.int64)
    for q in np.argsort(own / size, kind="stable"):  # likeliest hubs first
        done[q] = True
        open_ = 100 * np.minimum(shared, shared[q]) >= percent * np.maximum(size + own[q], size[q] + own)
        open_ &= (part != part[q]) & ~done
        if not open_.any():
            continue
        np.cumsum(open_, out=wanted[1:])
        marks[trie.sets[q]] = True
        for leaf in trie.walk(trie.sets[q], marks, wanted, percent):
            if part[leaf] != part[q]:
                part[part == part[leaf]] = part[q]
                out.append((trie.order[q], trie.order[leaf]))
        marks[trie.sets[q]] = False
    return out


def _joiner(percent: int):
    """Joins the runs of equal (hood, i, j) of a sorted partition."""
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, sets = None, [], []

        def links() -> Iterator[pa.RecordBatch]:
            one = {c: s for c, s in zip(ids, sets)}
            if len(one) > 1:
                names = list(one)
                pairs = trie_links(list(one.values()), percent)
                if pairs:
                    yield pa.RecordBatch.from_arrays([pa.array([names[x] for x, _ in pairs], pa.int64()),
                                                      pa.array([names[y] for _, y in pairs], pa.int64())], ["a", "b"])

        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            cids, lists = batch.column(3).to_pylist(), batch.column(4)
            where = np.asarray(lists.offsets)
            values = np.asarray(lists.values).view(np.uint64)
            for r, k in enumerate(keys):
                if k != key:
                    yield from links()
                    key, ids, sets = k, [], []
                ids.append(cids[r])
                sets.append(values[where[r]:where[r + 1]].copy())
        yield from links()
    return join


def _peeled(prefix: DataFrame) -> DataFrame:
    """``prefix`` with the elements that a set of the same or a neighbouring size
    class has too; sets that have too few of these left are dropped."""
    each = prefix.select("cid", "c", F.explode("alive").alias("x"))
    counted = each.where("x.part = 0")
    near = counted.select(F.col("x.e").alias("e"), F.explode(F.array(F.col("c") - 1, F.col("c"), F.col("c") + 1)).alias("c")) \
        .groupBy("e", "c").count().where("count > 1").select("e", "c")
    near = written(near, "near")
    stay = counted.withColumn("e", F.col("x.e")).join(near, ["e", "c"]).select("cid", "x").unionAll(each.where("x.part = 1").select("cid", "x"))
    alive = stay.groupBy("cid").agg(F.sort_array(F.collect_list("x")).alias("alive"))
    return prefix.drop("alive").join(alive, "cid").withColumn("own", F.col("heads") - F.size("alive")).where("need > own") \
        .select(*prefix.columns)


def similar(docs: DataFrame, n: int = 3, percent: int = 90, id_column: str = "doc_id",
            block_elements: int = 3_000_000) -> DataFrame:
    """Per row of ``docs`` (``id_column``, text): ``n_shingles`` (set size),
    ``component_id`` (smallest id reachable by links, itself included)."""
    id_type = docs.schema[id_column].dataType.simpleString()
    hashed = docs.select(id_column, F.xxhash64("text").alias("text_hash"), "text")
    rows = hashed.mapInArrow(_summaries(n, percent, id_column),
                             f"{id_column} {id_type}, text_hash long, n long, s1 long, s2 long, head array<long>")
    # rid: a row that stands for its class; repeated rows share it
    rows = written(rows.select(id_column, "n", F.xxhash64("n", "s1", "s2").alias("cid"), F.xxhash64(id_column, "text_hash").alias("rid"),
                               F.size("head").alias("heads"), "head"), "sets")
    classes = rows.where("n > 0").groupBy("cid").agg(F.min("rid").alias("rid"), F.min(id_column).alias("least"), F.first("n").alias("n"),
                                                     F.first("heads").alias("heads"))
    classes = written(classes, "classes")
    # hashes are unsigned, Spark's longs are signed
    limit = first_part(percent)
    first = (F.col("e") >= 0) & (F.col("e") < F.lit(limit)) if limit < 2**63 else (F.col("e") >= 0) | (F.col("e") < F.lit(limit - 2**64))
    ones = rows.where("n > 0").join(bounded_broadcast(classes.select("rid"), BROADCAST_ROWS), "rid", "left_semi")
    elements = ones.select("cid", F.explode("head").alias("e")).withColumn("first", first)
    frequent = written(elements.where("first").groupBy("e").count().where("count > 1"), "frequent")
    known = elements.where("first").join(frequent, "e").select("cid", F.struct(F.lit(0).alias("part"), F.col("count").alias("place"), "e").alias("x"))
    rest = elements.where("not first").select("cid", F.struct(F.lit(1).alias("part"), F.col("e").bitwiseXOR(F.lit(-2**63)).alias("place"), "e").alias("x"))
    alive = known.unionAll(rest).groupBy("cid").agg(F.sort_array(F.collect_set("x")).alias("alive"))
    # a set meets sets of its own and the neighbouring size class only
    step = 1.0001 * math.log(100 / percent) if percent < 100 else 1.0  # wider by a hair: logarithms are rounded
    need = (F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100) + 1).cast("int")
    own = F.col("heads") - F.size("alive")
    prefix = classes.select("cid", "n", "heads", "rid").join(alive, "cid") \
        .withColumn("own", own).withColumn("need", need).where("need > own") \
        .select("cid", "n", "rid", "own", "heads", "need", "alive", F.floor(F.log("n") / F.lit(step)).alias("c"))
    prefix = written(prefix, "prefixes")
    for _ in range(PEELS):
        prefix = written(_peeled(prefix), "prefixes")
    prefix = prefix.withColumn("prefix", F.slice("alive.e", F.lit(1), F.col("need") - F.col("own")))
    keyed = prefix.select("cid", F.explode("prefix").alias("e"), "c") \
        .select("cid", "e", F.explode(F.array("c", F.col("c") + 1)).alias("c"))
    keyed = keyed.select("cid", F.xxhash64("e", "c").alias("k"))
    stars = keyed.groupBy("k").agg(F.min("cid").alias("b"), F.max("cid").alias("other")).where("b <> other").select("k", "b")
    hoods = components(keyed.join(stars, "k").select(F.col("cid").alias("a"), "b"))
    hood = written(prefix.join(hoods.withColumnRenamed("id", "cid"), "cid")
                   .select("cid", F.col("root").alias("hood"), "n", "own", "rid"), "hoods")
    large = hood.groupBy("hood").agg(F.ceil(F.sum("n") / F.lit(block_elements)).cast("int").alias("blocks"),
                                     F.min_by("cid", F.struct(F.col("own") / F.col("n"), "cid")).alias("hub")).where("blocks > 1")
    large = bounded_broadcast(written(large, "large-hoods"), BROADCAST_ROWS)
    read = bounded_broadcast(hood.select("rid", "cid", "hood"), BROADCAST_ROWS)
    found = hashed.select(F.xxhash64(id_column, "text_hash").alias("rid"), "text").join(read, "rid")
    sets = found.select("hood", "cid", "text").mapInArrow(_full_sets(n), "hood long, cid long, set array<long>")
    block = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    each = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                       lambda j: F.struct(F.least(F.col("own"), j).alias("i"), F.greatest(F.col("own"), j).alias("j")))
    all_ = F.flatten(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                                 lambda i: F.transform(F.sequence(i, F.col("blocks") - 1), lambda j: F.struct(i.alias("i"), j.alias("j")))))
    sets = sets.join(large, "hood", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("own", block) \
        .withColumn("at", F.explode(F.when(F.col("cid") == F.col("hub"), all_).otherwise(each))) \
        .select("hood", F.col("at.i").alias("i"), F.col("at.j").alias("j"), "cid", "set")
    sets = sets.repartition("hood", "i", "j").sortWithinPartitions("hood", "i", "j")
    links = sets.mapInArrow(_joiner(percent), "a long, b long")
    labels = components(links)
    named = classes.select("cid", "least").join(labels.withColumnRenamed("id", "cid"), "cid", "left") \
        .withColumn("root", F.coalesce("root", "cid"))
    named = written(named, "labels")
    least = written(named.groupBy("root").agg(F.min("least").alias("component")), "least")
    named = named.join(least, "root").select(F.col("cid").alias("_cid"), "component")
    return rows.join(named, F.col("cid") == F.col("_cid"), "left").select(
        id_column, F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col(id_column)).alias("component_id"))
