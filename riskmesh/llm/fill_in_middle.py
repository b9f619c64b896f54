"""Fill-in-middle transformation: cut a text at two unit boundaries into prefix,
middle and suffix and write the middle last, with markers, as training text.

1. Every code point gets a character class of three bits: its kind (other, white
   space, digit, A-Z letter) and whether it follows a letter of the same text. A
   unit (a run of letters, or one other code point) starts at every class but the
   highest, "letter after a letter".
2. The classes of a slice of texts go into a wavelet matrix: one bit row a level,
   packed, with counted words, so that ranks take constant time. Following the
   highest class down, the ranks of the branches not taken add up to the number of
   unit starts before a position; two of these counts give a text's units.
3. A cut after k units is found by bisection on that count, for all texts of the
   slice at once.
4. The two cuts, whether a text is transformed, and the order of the pieces come
   from the hash of seed and id, computed by Spark, so reruns agree.

``restore`` rebuilds the text from output and form with Spark's functions; a text
that holds a marker stays plain, so that is exact.

Defined cases: a null text is empty; an empty text has no units and is plain; a
null id hashes like an empty one; repeated rows give equal results; texts of any
length are cut whole; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmesh.llm.words import SPACE, texts

MARKERS = ("<P>", "<S>", "<M>")
LEVELS = 3
LETTER_AFTER_LETTER = 7
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[SPACE] = 1
_KIND[48:58] = 2
_KIND[65:91] = _KIND[97:123] = 3


class WaveletMatrix:
    """Ranks over a sequence of symbols of ``levels`` bits."""

    def __init__(self, symbols: np.ndarray, levels: int = LEVELS):
        self.n, self.levels = len(symbols), levels
        self.words, self.counts, self.zeros = [], [], []
        for level in range(levels - 1, -1, -1):
            bit = (symbols >> level) & 1
            packed = np.packbits(bit, bitorder="little")
            whole = np.zeros((len(packed) // 8 + 1) * 8, dtype=np.uint8)   # one word beyond the last position
            whole[: len(packed)] = packed
            words = whole.view("<u8")
            counts = np.zeros(len(words) + 1, dtype=np.int64)
            np.cumsum(np.bitwise_count(words), out=counts[1:])
            self.words.append(words)
            self.counts.append(counts)
            self.zeros.append(self.n - int(counts[-1]))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def _ones(self, row: int, i: np.ndarray) -> np.ndarray:
        """Set bits before position i of a bit row."""
        word, rest = i >> 6, (i & 63).astype(np.uint64)
        below = (np.uint64(1) << rest) - np.uint64(1)
        return self.counts[row][word] + np.bitwise_count(self.words[row][word] & below)

    def less(self, symbol: int, i: np.ndarray) -> np.ndarray:
        """Symbols below ``symbol`` among the first i."""
        if symbol >= 1 << self.levels:
            return np.asarray(i).copy()
        low, high = np.zeros(1, dtype=np.int64), np.asarray(i, dtype=np.int64)
        total = np.zeros(len(high), dtype=np.int64)
        for row in range(self.levels):
            ones_low, ones_high = self._ones(row, low), self._ones(row, high)
            if symbol >> (self.levels - 1 - row) & 1:
                total += (high - ones_high) - (low - ones_low)
                low, high = self.zeros[row] + ones_low, self.zeros[row] + ones_high
            else:
                low, high = low - ones_low, high - ones_high
        return total


class Units:
    """Units of consecutive texts: ``first`` and ``n`` code points and units."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, starts: int = LETTER_AFTER_LETTER):
        self.starts = starts                                         # classes below start a unit
        self.at = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))   # byte of every code point
        self.edges = np.searchsorted(self.at, offsets)
        kind = _KIND[raw[self.at[:-1]]]
        follows = np.zeros(len(kind), dtype=np.uint8)
        follows[1:] = kind[:-1] == 3
        follows[self.edges[:-1][self.edges[:-1] < len(kind)]] = 0
        self.matrix = WaveletMatrix(kind * 2 + follows)
        self.before = self.matrix.less(starts, self.edges)           # unit starts before each text
        self.n = np.diff(self.before)

    def cut(self, k: np.ndarray) -> np.ndarray:
        """Per text the code point (over all texts) where its first k units end."""
        low, high = self.edges[:-1].copy(), self.edges[1:].copy()    # the (k+1)-th start, or the text's end
        wanted = self.before[:-1] + k + 1
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) >> 1
            enough = self.matrix.less(self.starts, middle + 1) >= wanted[open_]
            high[open_[enough]] = middle[enough]
            low[open_[~enough]] = middle[~enough] + 1
        return low


def _transformer(id_column: str, rate: int, spm_rate: int, starts: int, markers: tuple[str, str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, s, m = (x.encode() for x in markers)
        for batch in batches:
            h = [np.asarray(batch.column(i)).astype(np.int64) for i in range(1, 5)]
            for begin, t in texts(batch.column(5)):
                units = Units(t.raw, t.offsets, starts)
                rows = slice(begin, begin + t.n)
                a, b = h[0][rows] % (units.n + 1), h[1][rows] % (units.n + 1)
                one, two = units.cut(np.minimum(a, b)), units.cut(np.maximum(a, b))
                chars, middle = one - units.edges[:-1], two - one
                cuts, raw = np.stack([t.offsets[:-1], units.at[one], units.at[two], t.offsets[1:]], axis=1).tolist(), t.raw.tobytes()
                transform = (h[2][rows] % 100 < rate).tolist()
                suffix_first = (h[3][rows] % 100 < spm_rate).tolist()
                form, out = [], []
                for i, (start, first, second, end) in enumerate(cuts):
                    text = raw[start:end]
                    if not transform[i] or not text or p in text or s in text or m in text:
                        form.append("plain")
                        out.append(text)
                    elif suffix_first[i]:
                        form.append("spm")
                        out.append(b"".join([s, raw[second:end], p, raw[start:first], m, raw[first:second]]))
                    else:
                        form.append("psm")
                        out.append(b"".join([p, raw[start:first], s, raw[second:end], m, raw[first:second]]))
                plain = np.array([f == "plain" for f in form], dtype=bool)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, t.n), pa.array(units.n), pa.array(form), pa.array(chars, pa.int64(), mask=plain),
                     pa.array(middle, pa.int64(), mask=plain), pa.array(out, pa.binary()).cast(pa.string())],
                    [id_column, "n", "form", "prefix_chars", "middle_chars", "output"])
    return run


def fill_in_middle(docs: DataFrame, seed: str = "1", rate: int = 90, spm_rate: int = 20, unit: str = "token",
                   markers: tuple[str, str, str] = MARKERS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: ``id_column``, ``n`` (units), ``form`` (plain, psm or spm),
    ``prefix_chars`` and ``middle_chars`` (code points; null if plain) and
    ``output``. ``rate`` percent are transformed, ``spm_rate`` percent of these
    with the suffix first; ``unit`` is "token" or "char" (every code point)."""
    starts = {"token": LETTER_AFTER_LETTER, "char": LETTER_AFTER_LETTER + 1}[unit]
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))), 256)
    numbers = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i}") for i in range(4)]
    id_type = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, *numbers, F.col(text_column).alias("text")).mapInArrow(
        _transformer(id_column, rate, spm_rate, starts, markers),
        f"{id_column} {id_type}, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that an ``output`` of the given ``form`` was made from."""
    first, second = (F.when(form == "psm", F.lit(markers[i])).otherwise(F.lit(markers[1 - i])) for i in range(2))
    body = F.substr(output, F.char_length(first) + 1)
    middle = F.instr(output, F.lit(markers[2]))
    cut = F.instr(body, second)
    one = F.substr(body, F.lit(1), cut - 1)
    two = F.substr(output, F.char_length(first) + cut + F.char_length(second), middle - F.char_length(first) - cut - F.char_length(second))
    rest = F.substr(output, middle + F.lit(len(markers[2])))
    return F.when(form == "plain", output).when(form == "psm", F.concat(one, rest, two)).otherwise(F.concat(two, rest, one))
