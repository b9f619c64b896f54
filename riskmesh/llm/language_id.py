"""Language identification by compression: a text is encoded with one zstandard
raw-content dictionary per language and belongs to the language whose dictionary
makes it smallest; a narrow margin rejects the answer.

Dictionaries are learned from a bounded sample of labelled rows: per language
the ``sample_docs`` rows with the smallest hash of their id, whole texts in that
order, up to ``dict_bytes``. Texts are reduced to lower-case words of letters and
encoded whole, in pieces of ``piece_bytes`` so that the dictionary still matters
late in a long text.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so
is every text if nothing could be learned; equal sizes go to the first language
by name; rows without a label teach nothing; repeated rows each get the same
answer; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LETTER = re.compile(r"[^\W\d_]")
OTHER = re.compile(r"[\W\d_]+")
MAX_LANGUAGES = 512


def _plain(text: str) -> bytes:
    """The text's words of letters in lower case: symbols and layout say nothing of the language."""
    return f" {OTHER.sub(' ', text.lower())} ".encode()


def learn_dictionaries(rows: DataFrame, sample_docs: int = 64, dict_bytes: int = 1 << 16, id_column: str = "doc_id") -> dict[str, bytes]:
    """{lang: dictionary content} from rows (``id_column``, text, lang). At most
    ``sample_docs`` texts a language come to the driver, one language at a time."""
    rows = rows.where("text is not null and lang is not null")
    counts = rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return {}
    # twice the sample by a bound on the hash, then the smallest: no task gathers more than that of a language
    bounds = rows.sparkSession.createDataFrame([(r["lang"], min(int(2 * sample_docs / r["count"] * 2**63), 2**63 - 1)) for r in counts],
                                               "_lang string, _bound long")
    hashed = rows.select("lang", "text", F.shiftrightunsigned(F.xxhash64(F.lit(5), id_column, "text"), 1).alias("hash"))
    near = hashed.join(F.broadcast(bounds), (F.col("lang") == F.col("_lang")) & (F.col("hash") <= F.col("_bound")))
    order = Window.partitionBy("lang").orderBy("hash", "text")
    sample = near.select("lang", "text", F.row_number().over(order).alias("at")).where(F.col("at") <= sample_docs)
    out: dict[str, list[bytes]] = {}
    for r in sample.orderBy("lang", "at").toLocalIterator():
        own = out.setdefault(r["lang"], [])
        if sum(map(len, own)) < dict_bytes:
            own.append(_plain(r["text"]))
    return {lang: b"".join(parts)[:dict_bytes] for lang, parts in out.items()}


def identify(docs: DataFrame, dictionaries: dict[str, bytes], id_column: str = "doc_id", level: int = 6,
             piece_bytes: int = 1 << 12, min_margin: float = 0.01) -> DataFrame:
    """Per row of ``docs`` (``id_column``, text): ``lang_pred``, ``score`` (how
    much smaller the best encoding is than the next best, 0 to 1) and
    ``accepted`` (the margin is wide enough)."""
    id_type = docs.schema[id_column].dataType.simpleString()
    langs = sorted(x for x in dictionaries if len(dictionaries[x]) >= 8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = []
        for lang in langs:
            d = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            encoders.append(zstandard.ZstdCompressor(level=level, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False))
        for batch in batches:
            pred, score, accepted = [], [], []
            for value in batch.column(1):
                text = value.as_py()
                if not text or not langs or not LETTER.search(text):
                    pred.append("und"), score.append(0.0), accepted.append(False)
                    continue
                raw = _plain(text)
                pieces = [raw[i: i + piece_bytes] for i in range(0, len(raw), piece_bytes)]
                sizes = [sum(len(e.compress(p)) for p in pieces) for e in encoders]
                best = min(range(len(langs)), key=sizes.__getitem__)
                rest = min((s for i, s in enumerate(sizes) if i != best), default=2 * sizes[best])
                pred.append(langs[best])
                score.append(1 - sizes[best] / rest)
                accepted.append(score[-1] >= min_margin)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(accepted, pa.bool_())],
                                             [id_column, "lang_pred", "score", "accepted"])

    return docs.select(id_column, "text").mapInArrow(run, f"{id_column} {id_type}, lang_pred string, score double, accepted boolean")
