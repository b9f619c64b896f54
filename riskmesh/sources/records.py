"""Landing text cut into records by many tasks: CSV whose quoted fields hold
newlines, and top-level JSON arrays, which no line reader can split.

Whether a place in the file is inside a quoted field (CSV: parity of quotes) or at
which depth it is (JSON: parity of unescaped quotes, then brackets outside strings)
depends on everything before it, so it is a prefix scan in two passes:

1. Spark splits the file into blocks of pieces (lines; for JSON the text between
   closing braces). Each task sums up its blocks: how a block changes the state, for
   either parity at its start.
2. A window over the blocks of a file (one small row a block) gives the state at
   every block's start. It is broadcast: a file has one row per
   ``spark.sql.files.maxPartitionBytes``.
3. Each task cuts its blocks into whole records; the pieces of a record that crosses
   blocks are put together by one more window over these few fragments.

The records are written once to the shared folder, so later passes (validation, the
bronze write) read them instead of parsing the text again."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskmesh.session import checkpoint_dir, ship

SEPARATOR = {"csv": "\n", "json": "}"}
# one CSV record: quotes only around a whole field, doubled inside
CSV_RECORD = r'(?s)^(?:[^",]*|"(?:[^"]|"")*")(?:,(?:[^",]*|"(?:[^"]|"")*"))*$'
JSON_LEAD = r"^[\s,\[\x{FEFF}]*"


class RecordError(ValueError):
    pass


def scan_csv(pieces: pa.Array, parity: int, depth: int = 0) -> tuple[np.ndarray, int, int]:
    """(mask of the lines that end a record, parity, 0) after ``pieces``."""
    quotes = np.asarray(pc.count_substring(pieces, '"')).astype(np.int64)
    after = (parity + np.cumsum(quotes)) & 1
    return after == 0, int(after[-1]) if len(after) else parity, 0


def scan_json(pieces: pa.Array, parity: int, depth: int) -> tuple[np.ndarray, int, int]:
    """(mask of the pieces whose closing brace ends an object of the top-level
    array, parity, depth) after ``pieces`` (each followed by a brace)."""
    bare = pc.replace_substring_regex(pieces, r"(?s)\\.", "")
    quotes = np.asarray(pc.count_substring(bare, '"')).astype(np.int64)
    total = parity + np.cumsum(quotes)
    after, before = total & 1, (total - quotes) & 1
    inside = pc.replace_substring_regex(bare, r'^[^"]*"?', "")        # the rest of a string that began before
    outside = pc.replace_substring_regex(pc.if_else(pa.array(before == 1), inside, bare), r'"[^"]*"?', "")
    opens, closes = (np.asarray(pc.count_substring_regex(outside, x)).astype(np.int64) for x in (r"[\[{]", r"\]"))
    depths = depth + np.cumsum(opens - closes - (after == 0))
    return (after == 0) & (depths == 1), int(after[-1]) if len(after) else parity, int(depths[-1]) if len(depths) else depth


SCAN = {"csv": scan_csv, "json": scan_json}


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, int]]:
    """(file, block, first row, end) of the batch's runs of one block."""
    files, blocks = batch.column(0).to_pylist(), np.asarray(batch.column(1))
    begin = 0
    for i in range(1, len(files) + 1):
        if i == len(files) or blocks[i] != blocks[begin] or files[i] != files[begin]:
            yield files[begin], int(blocks[begin]), begin, i
            begin = i


def _summaries(kind: str):
    """(file, block, flip, depth0, depth1): what a block does to the state."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict[tuple[str, int], list[int]] = {}
        for batch in batches:
            for file, block, a, b in _runs(batch):
                s = state.setdefault((file, block), [0, 0, 1, 0])
                pieces = batch.column(2).slice(a, b - a)
                for k in (0, 2):
                    _, s[k], s[k + 1] = SCAN[kind](pieces, s[k], s[k + 1])
        if state:
            rows = [(f, k, s[0], s[1], s[3]) for (f, k), s in state.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["file", "block", "flip", "depth0", "depth1"])
    return run


def _cutter(kind: str):
    """(file, block, part, first, text): whole records, and per block at most one
    ``head`` (the end of a record that began in an earlier block), ``middle`` (a
    block inside one record) and ``tail`` (the start of one that goes on)."""
    sep = SEPARATOR[kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parity, depth, opened, pieces, count = None, 0, 0, False, [], 0
        out: list[tuple] = []

        def close() -> None:      # the block's unfinished record
            if key is not None and (pieces or opened):
                out.append((*key, "middle" if opened else "tail", False, sep.join(pieces)))

        def rows() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.string()))],
                                               ["file", "block", "part", "first", "text"])
            out.clear()
            return batch

        for batch in batches:
            for file, block, a, b in _runs(batch):
                if key != (file, block):
                    close()
                    key, pieces, count = (file, block), [], 0
                    parity, depth = batch.column(3)[a].as_py(), batch.column(4)[a].as_py()
                    opened = parity == 1 or (kind == "json" and depth > 1)   # a record goes on from an earlier block
                text = batch.column(2).slice(a, b - a)
                ends, parity, depth = SCAN[kind](text, parity, depth)
                begins = np.r_[not pieces and not opened, ends[:-1]]
                alone = begins & ends
                if count == 0 and ends.any():      # the file's first record may be a header
                    alone[np.argmax(ends)] = False
                for i in np.flatnonzero(~alone).tolist():
                    pieces.append(text[i].as_py())
                    if ends[i]:
                        out.append((file, block, "head" if opened else "whole", block == 0 and count == 0 and not opened, sep.join(pieces)))
                        count, opened, pieces = count + 1, False, []
                if out:
                    yield rows()
                if alone.any():
                    whole = text.filter(pa.array(alone))
                    n, count = len(whole), count + len(whole)
                    yield pa.RecordBatch.from_arrays([pa.array([file] * n), pa.array([block] * n, pa.int64()), pa.array(["whole"] * n), pa.array([False] * n), whole],
                                                     ["file", "block", "part", "first", "text"])
        close()
        if out:
            yield rows()
    return run


def cut_records(spark: SparkSession, path: str, kind: str) -> tuple[DataFrame, str]:
    """(records (file, first, text) of ``path``, the scratch folder they are in).
    ``kind``: "csv" or "json"; ``first`` marks the first record of a file."""
    ship(spark)
    sep = SEPARATOR[kind]
    lines = spark.read.text(path, lineSep=sep).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    scratch = f"{checkpoint_dir(spark).rstrip('/')}/riskmesh-records-{uuid.uuid4().hex}"

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{scratch}/{name}")
        return spark.read.schema(df.schema).parquet(f"{scratch}/{name}")

    blocks = kept(lines.mapInArrow(_summaries(kind), "file string, block long, flip long, depth0 long, depth1 long"), "blocks")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("parity", F.coalesce(F.sum("flip").over(before), F.lit(0)) % 2)
    # with parity 1 at its start a block was summed up from depth 0 as well
    change = F.when(F.col("parity") == 0, F.col("depth0")).otherwise(F.col("depth1"))
    if kind == "json":
        # behind "]" there is one more piece, which counts a closing brace that is not there
        ends = starts.groupBy("file").agg(F.sum(change).alias("depth"), F.sum("flip").alias("flips"))
        cut_off = ends.where("depth <> -1 or flips % 2 = 1").select("file").limit(1).collect()
        if cut_off:
            raise RecordError(f"unfinished JSON array in {cut_off[0]['file']}")
    starts = starts.withColumn("depth", F.coalesce(F.sum(change).over(before), F.lit(0))).select("file", "block", "parity", "depth")
    cut = lines.join(F.broadcast(starts), ["file", "block"]).select("file", "block", "value", "parity", "depth") \
        .mapInArrow(_cutter(kind), "file string, block long, part string, first boolean, text string")
    cut = kept(cut, "records")
    end = "}" if kind == "json" else ""
    whole = cut.where("part = 'whole'").select("file", "first", F.concat("text", F.lit(end)).alias("text"))
    # a head comes before the tail of its block; a record starts with a tail
    place = F.when(F.col("part") == "tail", 1).otherwise(0)
    so_far = Window.partitionBy("file").orderBy("block", "place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fragments = cut.where("part <> 'whole'").withColumn("place", place) \
        .withColumn("owner", F.max(F.when(F.col("part") == "tail", F.col("block"))).over(so_far))
    joined = fragments.groupBy("file", "owner").agg(F.sort_array(F.collect_list(F.struct("block", "place", "text"))).alias("all"),
                                                    F.bool_or(F.col("part") == "head").alias("ended"))
    text = F.array_join(F.col("all.text"), sep)
    if kind == "json":     # what follows the last object is no record
        joined, text = joined.where("ended"), F.concat(text, F.lit("}"))
    else:
        joined = joined.where(F.col("ended") | (text != ""))
    return whole.unionByName(joined.select("file", F.lit(False).alias("first"), text.alias("text"))), scratch


def json_objects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Objects (``value``) of whole texts that each hold one array; for streams of
    small files."""
    for batch in batches:
        for value in batch.column(0).to_pylist():
            pieces = pa.array((value or "").split("}"))
            ends, parity, depth = scan_json(pieces, 0, 0)
            stops = np.flatnonzero(ends) + 1
            texts = pieces.to_pylist()
            begin, found = 0, []
            for stop in stops.tolist():
                found.append("}".join(texts[begin:stop]) + "}")
                begin = stop
            if value and value.strip() and (depth != -1 or parity):
                raise RecordError("unfinished JSON array")
            if found:
                yield pa.RecordBatch.from_arrays([pc.replace_substring_regex(pa.array(found), JSON_LEAD, "")], ["value"])


def checked_csv(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records without the carriage return of their line end; a quote that is not
    around a whole field is refused, as the scan would count it wrongly."""
    for batch in batches:
        text = pc.replace_substring_regex(batch.column(0), r"\r$", "")
        wrong = pc.and_(pc.match_substring(text, '"'), pc.invert(pc.match_substring_regex(text, CSV_RECORD)))
        if pc.any(wrong).as_py():
            raise RecordError(f"a quote inside a field: {text.filter(wrong)[0].as_py()[:200]!r}; read this file with multi_line=True")
        yield pa.RecordBatch.from_arrays([text], ["text"])
