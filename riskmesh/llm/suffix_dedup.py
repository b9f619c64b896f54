"""Suffix-array dedup: remove every byte that lies in a ``window``-byte string
that starts anywhere else too, by two-stage sorted suffix arrays.

1. Segments. The smallest hash of the ``gram``-byte strings in a window, where it
   stands first, is the window's anchor; equal windows have equal anchors at equal
   places. Consecutive windows with one anchor are a segment. Each pass over the texts sends (anchor, hash of the
   segment's bytes, place) only; segments whose anchor occurs once are out, exactly.
2. Equal segments are one class with a count, so thousands of copies cost one
   segment from here on, and the bytes of one member of each class are fetched.
3. Whole anchors go to tasks, sorted; a task fills blocks of ``block_bytes`` with
   them and makes a suffix array of each block: suffixes smaller than their
   successor are sorted directly, the rest is induced by bucket scans, and adjacent
   common prefixes are computed (``suffix_arrays.py``). Runs of suffixes that share
   ``window`` bytes, counted by their classes, are the repeated windows.
4. An anchor with more than ``block_bytes`` of distinct segments does not fit a
   block. There, hashes of single windows are counted first (with partial sums);
   of each window that is left two occurrences go into the blocks, on their own.
   That costs one hash a window for these segments, whatever the anchor's size.
5. Repeated windows go back to all members of their classes, and documents drop
   the bytes they cover. Texts are read in overlapping slices of one megabyte.

Defined cases: a null or empty text has no bytes and loses none; texts shorter
than the window lose nothing; rows that repeat (same id and text) are repeats of
each other; a text that repeats inside itself loses all places, overlapping ones
included; a cut may fall inside a character, so what is kept is binary; a null id
is an id; other columns are not read; an empty table gives no rows. Anchors,
segments and windows stand for their bytes by hashes of 64 bits each, two of them
together; what the suffix array finds is compared byte for byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmesh.llm.shared import bounded_broadcast, written
from riskmesh.llm.suffix_arrays import agree_with_next, suffix_array, words_at
from riskmesh.llm.words import _CODES, SLICE_BYTES, _power, mix

BROADCAST_ROWS = 2_000_000
OUT_BYTES = 4 << 20
OUT_WINDOWS = 1 << 17


class Spans:
    """Hashes of byte spans of one buffer."""

    def __init__(self, raw: np.ndarray):
        up, self.down = _power(len(raw) + 1)
        self.total = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(_CODES[raw] * up[:-1], out=self.total[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.total[ends] - self.total[starts]) * self.down[starts])


def least_of(x: np.ndarray, k: int) -> np.ndarray:
    """Minimum of x[i:i+k] for every i with k values left."""
    width, out = 1, x
    while 2 * width <= k:
        out = np.minimum(out[:-width], out[width:])
        width *= 2
    return np.minimum(out[: len(out) - (k - width)], out[k - width:]) if k > width else out


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string or binary column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, dtype=np.int64)[column.offset: column.offset + len(column) + 1] if len(column) else np.zeros(1, dtype=np.int64)
    return offsets, np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)


def slices(column: pa.Array, overlap: int, slice_bytes: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, first byte in its text, offsets, bytes) of consecutive pieces of texts,
    about ``slice_bytes`` at a time. Longer texts are cut so that every string of
    ``overlap`` + 1 bytes lies in exactly one piece as a start."""
    offsets, data = buffers(column)
    n, begin = len(offsets) - 1, 0
    while begin < n:
        end = min(max(int(np.searchsorted(offsets, offsets[begin] + slice_bytes, side="right")) - 1, begin + 1), n)
        low, high = int(offsets[begin]), int(offsets[end])
        if high - low <= slice_bytes + overlap:
            yield np.arange(begin, end), np.zeros(end - begin, dtype=np.int64), offsets[begin: end + 1] - low, data[low:high]
        else:  # one long text
            for at in range(0, high - low - overlap, slice_bytes):
                piece = data[low + at: min(low + at + slice_bytes + overlap, high)]
                yield np.array([begin]), np.array([at]), np.array([0, len(piece)]), piece
        begin = end


def _emit_segments(window: int, gram: int):
    """(anchor, seg, key, pos, n): every segment, by the hash of its bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.asarray(batch.column(0))
            for row, at, offsets, raw in slices(batch.column(1), window - 1):
                if len(raw) < window:
                    continue
                spans, grams = Spans(raw), np.arange(len(raw) - gram + 1)
                grams = spans.of(grams, grams + gram)
                least = least_of(grams, window - gram + 1)
                piece = np.repeat(np.arange(len(row), dtype=np.int32), np.diff(offsets))
                start = np.flatnonzero(piece[: len(raw) - window + 1] == piece[window - 1:])
                if not len(start):
                    continue
                anchor, piece = least[start], piece[start]
                # the leftmost place of the anchor changes as well where it leaves the window and comes again
                leaves = grams[start] == anchor
                first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1]) | leaves[:-1]])
                n = np.diff(np.append(first, len(start)))
                begin, piece = start[first], piece[first]
                seg = spans.of(begin, begin + n - 1 + window)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor[first].view(np.int64)), pa.array(seg.view(np.int64)), pa.array(keys[row[piece]]),
                     pa.array((at[piece] + begin - offsets[piece]).astype(np.int32)), pa.array(n.astype(np.int32))], ["anchor", "seg", "key", "pos", "n"])
    return run


def _fields(batch: pa.RecordBatch, offsets: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """(first byte of the text of each listed segment, the list's fields) of the
    third column, a list of structs a row."""
    lists = batch.column(2)
    flat = lists.flatten()
    fields = {f.name: np.asarray(flat.field(i)) for i, f in enumerate(flat.type)}
    return np.repeat(offsets[:-1], np.asarray(lists.value_lengths())), fields


def _emit_windows(window: int):
    """(anchor, seg, off, hash, weight) of every single window of the listed segments."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = buffers(batch.column(1))
            text, f = _fields(batch, offsets)
            edges = np.r_[0, np.cumsum(f["n"].astype(np.int64))]
            begin = 0
            while begin < len(text):
                end = max(begin + 1, int(np.searchsorted(edges, edges[begin] + OUT_WINDOWS, side="right")) - 1)
                part = slice(begin, end)
                n = f["n"][part].astype(np.int64)
                size = n + window - 1
                # the listed segments end to end, and the windows in them
                front = np.cumsum(size) - size
                raw = data[np.repeat(text[part] + f["pos"][part] - front, size) + np.arange(size.sum())]
                off = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                at = np.repeat(front, n) + off
                hashes = Spans(raw).of(at, at + window)
                columns = [np.repeat(f["anchor"][part], n), np.repeat(f["seg"][part], n), off.astype(np.int32), hashes.view(np.int64), np.repeat(f["weight"][part], n)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "seg", "off", "hash", "weight"])
                begin = end
    return run


def _emit_bytes(window: int):
    """(single, home, item, weight, bytes) of the listed segments."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = buffers(batch.column(1))
            text, f = _fields(batch, offsets)
            size = f["n"].astype(np.int64) + window - 1
            edges = np.r_[0, np.cumsum(size)]
            begin = 0
            while begin < len(text):
                end = max(begin + 1, int(np.searchsorted(edges, edges[begin] + OUT_BYTES, side="right")) - 1)
                part = slice(begin, end)
                where = (edges[begin: end + 1] - edges[begin]).astype(np.int32)
                raw = data[np.repeat(text[part] + f["pos"][part] - where[:-1], size[part]) + np.arange(where[-1])]
                data_column = pa.Array.from_buffers(pa.binary(), end - begin, [None, pa.py_buffer(where.tobytes()), pa.py_buffer(raw.tobytes())])
                yield pa.RecordBatch.from_arrays([pa.array(f[c][part]) for c in ("single", "home", "item", "weight")] + [data_column],
                                                 ["single", "home", "item", "weight", "bytes"])
                begin = end
    return run


def repeats_in_block(segments: list[np.ndarray], weights: np.ndarray, window: int) -> list[tuple[int, int, int]]:
    """(segment, first, end): ranges of window starts of ``segments`` (bytes without
    0xFF) whose ``window`` bytes start at another place of them too; a segment of
    weight 2 stands for two."""
    size = np.array([len(x) for x in segments], dtype=np.int64)
    begin = np.cumsum(size + 1) - size - 1
    s = np.zeros(int((size + 1).sum()), dtype=np.uint8)       # 0 ends a segment, bytes are one higher
    inside = np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size)
    s[inside] = np.concatenate(segments) + 1
    spans = Spans(s)
    at = np.arange(len(s))
    words = words_at(s, window)
    alike = spans.of(at, np.minimum(at + window, len(s)))
    order = suffix_array(s, words, window, alike)
    shared = agree_with_next(order, s, words, window, alike)
    weight = np.zeros(len(s), dtype=np.int64)                 # of window starts; the others reach over a segment's end
    starts = np.maximum(size - window + 1, 0)
    weight[np.repeat(begin, starts) + np.arange(starts.sum()) - np.repeat(np.cumsum(starts) - starts, starts)] = np.repeat(weights, starts)
    run = np.r_[0, np.cumsum(~shared)]
    hit = np.zeros(len(s), dtype=bool)
    hit[order] = (np.bincount(run, weights=weight[order]) >= 2)[run]
    hit &= weight > 0
    edge = np.diff(np.r_[0, hit.astype(np.int8), 0])
    first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    seg = np.searchsorted(begin, first, side="right") - 1
    return list(zip(seg.tolist(), (first - begin[seg]).tolist(), (end - begin[seg]).tolist()))


def _sort_blocks(window: int, block_bytes: int):
    """(single, home, item, first, end) over rows sorted by (single, home, item);
    a block takes whole homes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []       # of the block that is being filled
        held, whole, whole_bytes = 0, 0, 0   # bytes, and how many rows end with a whole home

        def flush(upto: int) -> Iterator[pa.RecordBatch]:
            part = rows[:upto]
            found = repeats_in_block([r[4] for r in part], np.array([r[3] for r in part]), window)
            if found:
                seg, first, end = zip(*found)
                one = [part[i] for i in seg]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in one], pa.bool_()), pa.array([r[1] for r in one], pa.int64()), pa.array([r[2] for r in one], pa.int64()),
                                                  pa.array(first, pa.int32()), pa.array(end, pa.int32())], ["single", "home", "item", "first", "end"])

        for batch in batches:
            names = zip(*(batch.column(i).to_pylist() for i in range(4)))
            offsets, data = buffers(batch.column(4))
            for r, (single, home, item, weight) in enumerate(names):
                if rows and rows[-1][:3] == (single, home, item):
                    continue                                  # a repeated row of documents sent it again
                if rows and rows[-1][:2] != (single, home):
                    whole, whole_bytes = len(rows), held
                size = int(offsets[r + 1] - offsets[r])
                if held + size > block_bytes and whole:
                    yield from flush(whole)
                    rows, held, whole = rows[whole:], held - whole_bytes, 0
                rows.append((single, home, item, weight, data[offsets[r]: offsets[r + 1]].copy()))
                held += size
        if rows:
            yield from flush(len(rows))
    return run


def _fetch(docs: DataFrame, listed: DataFrame, emit, schema: str) -> DataFrame:
    """``emit`` over the texts of ``docs`` (key, text) with their list of structs."""
    lists = written(listed.groupBy("key").agg(F.collect_list(F.struct(*[c for c in listed.columns if c != "key"])).alias("listed")), "lists")
    some = docs.join(bounded_broadcast(lists.select("key"), BROADCAST_ROWS), "key", "left_semi")
    return some.join(lists, "key").select("key", "text", "listed").mapInArrow(emit, schema)


def repeated_windows(docs: DataFrame, window: int = 200, gram: int = 64, block_bytes: int = 1 << 20) -> DataFrame:
    """(key, first, end): ranges of byte positions of ``docs`` (key, text) at which
    ``window`` bytes start that start at another place too."""
    segments = written(docs.select("key", "text").mapInArrow(_emit_segments(window, gram), "anchor long, seg long, key long, pos int, n int"), "segments")
    shared = written(segments.groupBy("anchor").count().where("count > 1").select("anchor"), "anchors")
    members = written(segments.join(bounded_broadcast(shared, BROADCAST_ROWS), "anchor"), "members")
    classes = members.groupBy("anchor", "seg").agg(F.first("key").alias("key"), F.first("pos").alias("pos"), F.first("n").alias("n"),
                                                   F.least(F.count("*"), F.lit(2)).cast("int").alias("weight"))
    classes = written(classes, "classes")
    large = written(classes.groupBy("anchor").agg(F.sum(F.col("n") + window - 1).alias("bytes")).where(F.col("bytes") > block_bytes).select("anchor"), "large")
    fits = classes
    columns = ["key", F.lit(False).alias("single"), F.col("anchor").alias("home"), F.col("seg").alias("item"), "pos", "n", "weight"]
    split = large.limit(1).count() > 0
    if split:
        large = bounded_broadcast(large, BROADCAST_ROWS)
        fits = classes.join(large, "anchor", "left_anti")
        windows = _fetch(docs, classes.join(large, "anchor"), _emit_windows(window), "anchor long, seg long, off int, hash long, weight int")
        windows = written(windows, "windows")
        place = F.xxhash64("seg", "off")
        again = windows.groupBy("anchor", "hash").agg(F.max("weight").alias("w"), F.min(place).alias("a"), F.max(place).alias("b")) \
            .where("w = 2 or a <> b").select("anchor", "hash", "a", "b")
        again = written(again, "again")
        windows = written(windows.join(again, ["anchor", "hash"]).withColumn("place", place).withColumn("home", F.xxhash64("anchor", "hash")), "again-windows")
        two = windows.where("place = a or place = b").join(classes.select("anchor", "seg", "key", "pos"), ["anchor", "seg"])
        singles = two.select("key", F.lit(True).alias("single"), "home", F.col("place").alias("item"), (F.col("pos") + F.col("off")).alias("pos"),
                             F.lit(1).alias("n"), "weight")
    listed = fits.select(*columns)
    if split:
        listed = listed.unionAll(singles)
    bytes_ = _fetch(docs, listed, _emit_bytes(window), "single boolean, home long, item long, weight int, bytes binary")
    blocks = bytes_.repartition("single", "home").sortWithinPartitions("single", "home", "item")
    found = written(blocks.mapInArrow(_sort_blocks(window, block_bytes), "single boolean, home long, item long, first int, end int"), "repeats")
    ranges = found.where("not single").select(F.col("home").alias("anchor"), F.col("item").alias("seg"), "first", "end")
    if split:
        sure = found.where("single").select("home").distinct()
        ranges = ranges.unionAll(windows.select("home", "anchor", "seg", "off").distinct().join(written(sure, "sure"), "home")
                                 .select("anchor", "seg", F.col("off").alias("first"), (F.col("off") + 1).alias("end")))
        ranges = written(ranges, "ranges")
    return members.join(ranges, ["anchor", "seg"]).select("key", (F.col("pos") + F.col("first")).alias("first"), (F.col("pos") + F.col("end")).alias("end"))


def _cleaner(window: int, with_text: bool):
    """(key, n_removed, removed, kept_sha256[, kept]) of documents with repeated windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = buffers(batch.column(1))
            lists = batch.column(2)
            where, flat = np.r_[0, np.cumsum(np.asarray(lists.value_lengths()))], lists.flatten()
            first, end = (np.asarray(flat.field(i)).astype(np.int64) for i in range(2))
            n_removed, removed, digests, kept = [], [], [], []
            for r in range(batch.num_rows):
                raw = data[offsets[r]: offsets[r + 1]]
                delta = np.zeros(len(raw) + 1, dtype=np.int32)
                np.add.at(delta, first[where[r]: where[r + 1]], 1)
                np.add.at(delta, end[where[r]: where[r + 1]] + window - 1, -1)
                gone = np.cumsum(delta[:-1]) > 0
                edge = np.diff(np.r_[0, gone.astype(np.int8), 0])
                n_removed.append(int(gone.sum()))
                removed.append([{"first": a, "end": b} for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())])
                rest = raw[~gone].tobytes()
                digests.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest)
            columns = [batch.column(0), pa.array(n_removed, pa.int64()), pa.array(removed, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))), pa.array(digests)]
            names = ["key", "n_removed", "removed", "kept_sha256"]
            if with_text:
                columns.append(pa.array(kept, pa.binary()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(columns, names)
    return run


def remove_repeats(docs: DataFrame, window: int = 200, gram: int = 64, id_column: str = "doc_id", with_text: bool = False,
                   block_bytes: int = 1 << 20) -> DataFrame:
    """Per row of ``docs`` (``id_column``, text): ``n_bytes``, ``n_removed``,
    ``removed`` (the maximal removed runs, byte positions), ``kept_sha256``
    (with_text: also ``kept``, binary, null where nothing was removed)."""
    if not 1 <= gram <= window:
        raise ValueError("gram must be between 1 and window")
    keyed = docs.select(id_column, F.xxhash64(id_column, "text").alias("key"), "text")
    ranges = repeated_windows(keyed, window, gram, block_bytes)
    lists = written(ranges.groupBy("key").agg(F.collect_list(F.struct("first", "end")).alias("ranges")), "ranges")
    some = keyed.select("key", "text").join(bounded_broadcast(lists.select("key"), BROADCAST_ROWS), "key", "left_semi")
    schema = "_key long, n_removed long, removed array<struct<first: long, end: long>>, kept_sha256 string" + (", kept binary" if with_text else "")
    cleaned = some.join(lists, "key").select("key", "text", "ranges").mapInArrow(_cleaner(window, with_text), schema.replace("_key", "key", 1))
    cleaned = cleaned.dropDuplicates(["key"]).withColumnRenamed("key", "_key")
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = keyed.select(id_column, "key", F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("whole"))
    out = rows.join(cleaned, F.col("key") == F.col("_key"), "left")
    none = F.array().cast("array<struct<first: long, end: long>>")
    return out.select(id_column, "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("removed", none).alias("removed"),
                      F.coalesce("kept_sha256", "whole").alias("kept_sha256"), *(["kept"] if with_text else []))
