"""Document statistics for the quality classifier, computed over whole Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from .bytespan import Rolling, U, Words, byte_symbols, mix, pieces, text_bytes

NAMES = (
    "words", "word_len", "word_len_sd", "symbols", "upper", "digits", "bangs", "stops", "commas",
    "lines", "wide", "distinct", "top_word", "repeat_words", "repeat_lines", "short_words", "bars", "symbol_words",
)

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _kinds() -> np.ndarray:
    """Of each byte, a bit for each class that is counted."""
    k = np.zeros((256, 8), bool)
    k[:, 0] = _SYMBOL
    k[0x41:0x5B, 1] = True
    k[0x30:0x3A, 2] = True
    k[ord("!"), 3] = True
    k[list(b".?"), 4] = True
    k[ord(","), 5] = True
    k[ord("\n"), 6] = True
    k[0xC0:, 7] = True
    return k


_KINDS = _kinds()


def _repeats(owner: np.ndarray, key: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each owner: distinct keys, its most frequent key's count, and keys that repeat an earlier one."""
    if not len(key):
        return np.zeros(n), np.zeros(n), np.zeros(n)
    _, at, count = np.unique(mix(key + owner.astype(np.uint64) * U(0x9E3779B97F4A7C15)), return_index=True, return_counts=True)
    who = owner[at]
    top = np.zeros(n)
    np.maximum.at(top, who, count)
    distinct = np.bincount(who, minlength=n)
    return distinct, top, np.bincount(owner, minlength=n) - distinct


def statistics(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(texts, len(NAMES)): logarithms of lengths and shares; an empty text has zero counts throughout."""
    out = np.zeros((len(starts), len(NAMES)))
    for i, j in pieces(starts, ends):
        n = j - i
        s, e = starts[i:j], ends[i:j]
        w = Words(data, s, e)
        raw, lo = w.bytes, int(s[0])
        size = (e - s).astype(float)
        owner = np.repeat(np.arange(n), e - s) if size.sum() == len(raw) else np.searchsorted(s - lo, np.arange(len(raw)), "right") - 1
        kinds = _KINDS[raw]
        c = [np.bincount(owner[np.flatnonzero(kinds[:, k])], minlength=n) for k in range(8)]
        words = (w.after - w.first).astype(float)
        length = (w.stop - w.start).astype(float)
        total = np.bincount(w.text, length, n)
        square = np.bincount(w.text, length * length, n)
        per = np.maximum(words, 1)
        mean = total / per
        distinct, top, _ = _repeats(w.text, w.hash, n)
        three = np.flatnonzero(w.fits(3))
        _, _, again = _repeats(w.text[three], Rolling(w.hash).windows(3)[three], n) if len(three) else (0, 0, np.zeros(n))
        # lines: from each line feed or text start to the next
        marks = np.unique(np.concatenate([s[size > 0] - lo, np.flatnonzero(raw == 10) + 1]))
        marks = marks[marks < len(raw)]
        stop = np.minimum(np.append(marks[1:], len(raw)), (e - lo)[owner[marks]]) if len(marks) else marks
        long_line = stop - marks > 1
        line_key = Rolling(byte_symbols(raw)).spans(marks, stop)[long_line] if len(marks) else np.zeros(0, np.uint64)
        line_owner = owner[marks][long_line] if len(marks) else np.zeros(0, np.int64)
        _, _, line_again = _repeats(line_owner, line_key, n)
        lines = np.maximum(np.bincount(line_owner, minlength=n), 1)
        short = np.bincount(w.text[length <= 3], minlength=n)
        spiked = np.bincount(w.text[_SYMBOL[raw[w.stop - 1]]], minlength=n) if len(w.stop) else np.zeros(n)
        bars = np.bincount(owner[raw == ord("|")], minlength=n)
        b = np.maximum(size, 1)
        share = np.stack(
            [c[0] / b, c[1] / b, c[2] / b, c[3] / per, c[4] / per, c[5] / per, c[6] / per, c[7] / b, distinct / per, top / per, again / per, line_again / lines, short / per, bars / per, spiked / per],
            axis=1,
        )
        out[i:j, 0] = np.log1p(words)
        out[i:j, 1] = np.log1p(mean)
        out[i:j, 2] = np.log1p(np.sqrt(np.maximum(square / per - mean * mean, 0)))
        out[i:j, 3:] = np.log(share + 0.01)
    return out


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: ``id`` and ``x``, an array of len(NAMES) doubles."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = statistics(*text_bytes(b.column(1)))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, len(NAMES), dtype=np.int32)), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), flat], ["id", "x"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string")).mapInArrow(scan, f"id {kind}, x array<double>")
