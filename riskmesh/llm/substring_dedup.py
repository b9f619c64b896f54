"""Substring dedup: remove every word that lies in a window of ``window`` words
whose word sequence starts anywhere else too.

1. Sparse suffixes. In each window the smallest hash of its ``block``-word grams
   is its anchor; equal windows have equal anchors, so only windows whose anchor
   occurs twice or more (about one position in fifteen is an anchor) can repeat.
   Anchors are counted over all documents; everything else is out, exactly.
2. Prefix-partitioned suffix trees. A suffix that is left is its first ``window``
   words as a sequence of blocks. Groups are prefixes of one block, extended by
   further blocks until a group has at most ``group_rows`` suffixes; a prefix as
   long as the window needs no tree, its node is already deep enough. A task
   sorts the suffixes of its groups, so that each subtree is a run in order of
   its paths; internal nodes at depth ``window`` are runs of equal paths, read as
   a stream. Windows that repeat inside one slice of a task are known there and
   send one suffix, so a passage in a third of all documents stays small.
3. Positions go back to their documents, which drop the covered words.

Defined cases: a null or empty text has no words, nothing removed and the hash
of the empty string; texts shorter than the window lose nothing; rows that
repeat (same id and text) are repeats of each other; one text that repeats
inside itself loses both places, overlapping ones included; other columns are
not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmesh.llm.shared import bounded_broadcast, written
from riskmesh.llm.words import Texts, _spans, per_row, texts

BROADCAST_ROWS = 2_000_000
PART_BYTES = 3  # of each block's hash in a path


def _sliding(x: np.ndarray, k: int, op) -> np.ndarray:
    """op over x[i:i+k] for every i with k values left."""
    width, out = 1, x
    while 2 * width <= k:
        out = op(out[:-width], out[width:])
        width *= 2
    rest = k - width
    return op(out[:-rest], out[rest:]) if rest else out


def _anchors(t: Texts, hashes: np.ndarray, window: int, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start of every window, its anchor hash, hash of the gram at every word)."""
    if len(hashes) < window:
        none = np.zeros(0, dtype=np.int64)
        return none, none.astype(np.uint64), none.astype(np.uint64)
    at = np.arange(len(hashes) - block + 1)
    gram = _spans(hashes, at, at + block)
    least = _sliding(gram, window - block + 1, np.minimum)
    start = np.flatnonzero(t.row[: len(hashes) - window + 1] == t.row[window - 1:])
    return start, least[start], gram


def _emit_anchors(window: int, block: int):
    """(anchor, key of the document) for every position that is some window's anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.asarray(batch.column(0))
            for begin, t in texts(batch.column(1)):
                start, anchor, gram = _anchors(t, t.hashes(), window, block)
                if not len(start):
                    continue
                # a gram is an anchor if the largest of the minima of its windows is the gram itself
                span = window - block
                best = np.zeros(len(gram) + span, dtype=np.uint64)
                best[start + span] = anchor
                is_anchor = _sliding(best, span + 1, np.maximum) == gram
                is_anchor &= t.row[: len(gram)] == t.row[block - 1:]
                at = np.flatnonzero(is_anchor)
                yield pa.RecordBatch.from_arrays([pa.array(gram[at].view(np.int64)), pa.array(keys[begin + t.row[at]])], ["anchor", "key"])
    return run


def _emit_suffixes(window: int, block: int):
    """(path, key, pos, n) of windows with a shared anchor. Windows repeated in
    the slice go out with no path (known), and one of them as a path with n=2."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, shared = np.asarray(batch.column(0)), batch.column(2)
            where, values = np.asarray(shared.offsets), np.asarray(shared.values).view(np.uint64)
            for begin, t in texts(batch.column(1)):
                hashes = t.hashes()
                start, anchor, _ = _anchors(t, hashes, window, block)
                own = np.diff(where[begin: begin + t.n + 1])
                known = np.sort(per_row(values[where[begin]: where[begin + t.n]], np.repeat(np.arange(t.n), own)))
                if not len(start) or not len(known):
                    continue
                mine = per_row(anchor, t.row[start])
                at = np.minimum(np.searchsorted(known, mine), len(known) - 1)
                start = start[known[at] == mine]
                if not len(start):
                    continue
                parts = []
                for a in range(0, window, block):
                    h = _spans(hashes, start + a, start + min(a + block, window))
                    parts.append(np.ascontiguousarray(h.astype(">u8")).view(np.uint8).reshape(-1, 8)[:, :PART_BYTES])
                path = np.concatenate(parts, axis=1)
                whole = _spans(hashes, start, start + window)
                order = np.argsort(whole, kind="stable")
                s = whole[order]
                new = np.r_[True, s[1:] != s[:-1]]
                size = np.diff(np.r_[np.flatnonzero(new), len(s)])
                first = order[new]
                n = np.minimum(size, 2)
                again = order[np.repeat(size > 1, size)]
                key, pos = keys[begin + t.row[start]], start - t.first[t.row[start]]
                data = np.ascontiguousarray(path[first]).reshape(-1)
                width = path.shape[1]
                offsets = np.arange(len(first) + 1, dtype=np.int32) * width
                yield pa.RecordBatch.from_arrays(
                    [pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())]),
                     pa.array(key[first]), pa.array(pos[first].astype(np.int32)), pa.array(n.astype(np.int32))], ["path", "key", "pos", "n"])
                if len(again):
                    yield pa.RecordBatch.from_arrays(
                        [pa.nulls(len(again), pa.binary()), pa.array(key[again]), pa.array(pos[again].astype(np.int32)),
                         pa.array(np.full(len(again), 2, dtype=np.int32))], ["path", "key", "pos", "n"])
    return run


def _deep_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, pos) of the leaves below deep internal nodes: runs of one path with
    two or more suffixes, over rows sorted by path. State is one leaf."""
    held = last = None  # the single leaf of the last run if it has no partner yet, and the run's path
    for batch in batches:
        path, key, pos, n = batch.column(0), *(np.asarray(batch.column(i)) for i in (1, 2, 3))
        if not len(path):
            continue
        where = np.frombuffer(path.buffers()[1], dtype=np.int32)[path.offset: path.offset + len(path) + 1]
        data = np.frombuffer(path.buffers()[2], dtype=np.uint8)
        p = data[where[0]: where[-1]].reshape(len(path), -1)
        same = np.all(p[1:] == p[:-1], axis=1)
        run = np.r_[0, np.cumsum(~same)]
        total = np.bincount(run, weights=n)
        out = []
        if p[0].tobytes() == last:
            if held is not None:
                out.append((np.array([held[0]]), np.array([held[1]])))
            total[0] = 2
        deep = total >= 2
        hit = deep[run]
        out.append((key[hit], pos[hit]))
        last = p[-1].tobytes()
        held = None if deep[-1] else (key[-1], pos[-1])
        k, q = (np.concatenate(x) for x in zip(*out))
        if len(k):
            yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int64)), pa.array(q.astype(np.int32))], ["key", "pos"])


def _kept(t: Texts, gone: np.ndarray) -> Iterator[bytes]:
    """Per row the words that are not ``gone``, joined by one space."""
    raw = t.raw.copy()
    stay = ~gone
    order = np.flatnonzero(stay)
    first = np.ones(len(order), dtype=bool)
    first[1:] = t.row[order[1:]] != t.row[order[:-1]]
    delta = np.zeros(len(raw) + 1, dtype=np.int32)
    np.add.at(delta, t.starts[order], 1)
    np.add.at(delta, t.ends[order], -1)
    mask = np.cumsum(delta[:-1]) > 0
    joint = t.starts[order[~first]] - 1
    raw[joint] = 0x20
    mask[joint] = True
    out = raw[mask]
    cut = np.r_[0, np.cumsum(mask)][t.offsets]
    for i in range(t.n):
        yield out[cut[i]: cut[i + 1]].tobytes()


def _cleaner(window: int, with_text: bool):
    """(key, n_removed, kept_sha256[, text]) of documents with repeated windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            where, values = np.asarray(lists.offsets), np.asarray(lists.values).astype(np.int64)
            for begin, t in texts(batch.column(1)):
                counts = np.diff(where[begin: begin + t.n + 1])
                at = values[where[begin]: where[begin + t.n]] + np.repeat(t.first[:-1], counts)
                delta = np.zeros(len(t.row) + 1, dtype=np.int64)
                at = np.unique(at)
                delta[at] += 1
                np.add.at(delta, at + window, -1)
                gone = np.cumsum(delta[:-1]) > 0
                kept = list(_kept(t, gone))
                columns = [batch.column(0).slice(begin, t.n), pa.array(np.bincount(t.row[gone], minlength=t.n).astype(np.int64)),
                           pa.array([hashlib.sha256(x).hexdigest() for x in kept])]
                names = ["key", "n_removed", "kept_sha256"]
                if with_text:
                    columns.append(pa.array([x.decode("utf-8", "replace") for x in kept]))
                    names.append("kept_text")
                yield pa.RecordBatch.from_arrays(columns, names)
    return run


def _whole(id_column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, t in texts(batch.column(2)):
                kept = [hashlib.sha256(x).hexdigest() for x in _kept(t, np.zeros(len(t.row), dtype=bool))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, t.n), batch.column(1).slice(begin, t.n),
                                                  pa.array(t.n_words().astype(np.int64)), pa.array(kept)], [id_column, "key", "n_words", "whole"])
    return run


def repeated_windows(docs: DataFrame, window: int = 35, block: int = 7, group_rows: int = 500_000) -> DataFrame:
    """(key, pos): starts (in words) of windows of ``docs`` (key, text) whose
    word sequence starts at another place too."""
    anchors = docs.select("key", "text").mapInArrow(_emit_anchors(window, block), "anchor long, key long")
    anchors = written(anchors, "anchors")
    shared = anchors.groupBy("anchor").count().where("count > 1").select("anchor")
    shared = anchors.join(shared, "anchor").groupBy("key").agg(F.collect_set("anchor").alias("anchors"))
    shared = written(shared, "shared")
    some = docs.select("key", "text").join(bounded_broadcast(shared.select("key"), BROADCAST_ROWS), "key", "left_semi")
    suffixes = some.join(shared, "key").select("key", "text", "anchors") \
        .mapInArrow(_emit_suffixes(window, block), "path binary, key long, pos int, n int")
    suffixes = written(suffixes, "suffixes")
    width = -(-window // block) * PART_BYTES
    known = suffixes.where("path is null").select("key", "pos")
    dealt = suffixes.where("path is not null").withColumn("depth", F.lit(PART_BYTES))
    for depth in range(PART_BYTES, width, PART_BYTES):
        # prefixes that are still too large get one more block
        large = dealt.where(F.col("depth") == depth).groupBy(F.substring("path", 1, depth).alias("large")).count() \
            .where(F.col("count") > group_rows).select("large")
        large = written(large, "large")
        if large.limit(1).count() == 0:
            break
        dealt = dealt.join(bounded_broadcast(large, BROADCAST_ROWS), (F.col("depth") == depth) & (F.substring("path", 1, depth) == F.col("large")), "left") \
            .withColumn("depth", F.when(F.col("large").isNotNull(), depth + PART_BYTES).otherwise(F.col("depth"))).drop("large")
    dealt = dealt.repartition(F.expr("substring(path, 1, depth)")).sortWithinPartitions("path").select("path", "key", "pos", "n")
    return known.unionAll(dealt.mapInArrow(_deep_nodes, "key long, pos int"))


def remove_repeats(docs: DataFrame, window: int = 35, block: int = 7, id_column: str = "doc_id", with_text: bool = False) -> DataFrame:
    """Per row of ``docs`` (``id_column``, text): n_words, n_removed and
    kept_sha256 (with_text: also kept_text, null where nothing was removed)."""
    keyed = docs.select(id_column, F.xxhash64(id_column, "text").alias("key"), "text")
    starts = repeated_windows(keyed, window, block).groupBy("key").agg(F.collect_set("pos").alias("starts"))
    starts = written(starts, "starts")
    some = keyed.join(bounded_broadcast(starts.select("key"), BROADCAST_ROWS), "key", "left_semi")
    schema = "key long, n_removed long, kept_sha256 string" + (", kept_text string" if with_text else "")
    cleaned = some.join(starts, "key").select("key", "text", "starts").mapInArrow(_cleaner(window, with_text), schema)
    cleaned = cleaned.dropDuplicates(["key"]).withColumnRenamed("key", "_key")
    id_type = docs.schema[id_column].dataType.simpleString()
    rows = keyed.select(id_column, "key", "text").mapInArrow(_whole(id_column), f"{id_column} {id_type}, key long, n_words long, whole string")
    out = rows.join(cleaned, F.col("key") == F.col("_key"), "left")
    return out.select(id_column, "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
                      F.coalesce("kept_sha256", "whole").alias("kept_sha256"), *(["kept_text"] if with_text else []))
