"""Quality rules by compression bands: zstandard ratios of whole documents and of fixed chunks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.llm.textbytes import TextSlice, mixed, owners, per_document, text_slices, windows

SLICE = 1 << 19  # bytes of text that a worker judges at once
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Bands:
    """Accepted raw / compressed ratios by length in bytes: ``(shorter than, least, most)``, ascending.

    Frames cost a fixed number of bytes, so short texts have lower ratios. A chunk is
    ``chunk_bytes`` long; only whole chunks count. A document fails when its own ratio lies outside its
    band, or when more than ``chunk_share`` of its chunks lie outside ``chunk_band``.
    """

    level: int = 3
    limits: tuple[tuple[float, float, float], ...] = (
        (200, 0.85, 1.8), (500, 1.1, 2.1), (1_000, 1.25, 2.3), (2_000, 1.4, 2.5),
        (4_000, 1.5, 2.6), (10_000, 1.6, 2.8), (20_000, 1.7, 3.0), (float("inf"), 1.75, 3.3),
    )
    chunk_bytes: int = 4096
    chunk_band: tuple[float, float] = (1.5, 2.8)
    chunk_share: float = 0.3
    min_words: int = 20
    repeat_window: int = 8
    repeat_percent: int = 30


SIGNALS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, zstd_ratio double, n_chunks long, n_bad_chunks long, base_failed boolean, band_failed boolean, kept boolean"


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each key occurs again, and whether it occurred earlier."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    again, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    again[order[1:]] = same
    later[order[1:]] = same
    again[order[:-1]] |= same
    return again, later


def word_and_line_counts(s: TextSlice, window: int) -> dict[str, np.ndarray]:
    data, edges, n = s.data, s.edges, len(s)
    white = s.white()
    begins, ends = s.word_ranges(white)
    sums = s.prefix_codes(data)
    words, word_edges = s.range_hashes(sums, begins, ends), np.searchsorted(begins, edges)
    found, start = windows(words, word_edges, window)
    salt = mixed(np.arange(1, n + 1, dtype=np.uint64))
    again, _ = _repeats(found ^ salt[owners(word_edges)[start]])
    step = np.zeros(len(words) + 1, np.int64)
    step[: len(words)] = np.bincount(start[again], minlength=len(words) + 1)[: len(words)]
    step -= np.bincount(start[again] + window, minlength=len(words) + 1)
    covered = np.cumsum(step)[:-1] > 0
    # a line ends before each line feed and at the end of its document
    breaks = np.flatnonzero(data == 0x0A)
    line_begin = np.unique(np.concatenate([edges[:-1], breaks + 1]))
    line_begin = line_begin[line_begin < len(data)]
    line_end = np.minimum(np.append(line_begin[1:], len(data)), len(data))
    line_owner = np.searchsorted(edges, line_begin, side="right") - 1
    line_end = line_end - ((line_end > line_begin) & (data[np.maximum(line_end - 1, 0)] == 0x0A)) if len(data) else line_end
    has_word = np.searchsorted(begins, line_end) > np.searchsorted(begins, line_begin)
    lines = s.range_hashes(sums, line_begin[has_word], line_end[has_word]) ^ salt[line_owner[has_word]]
    _, earlier = _repeats(lines)
    return {
        "n_words": np.diff(word_edges),
        "word_chars": per_document(~white & ((data & 0xC0) != 0x80), edges),
        "n_symbols": per_document(_SYMBOLS[data], edges),
        "n_dup_lines": np.bincount(line_owner[has_word][earlier], minlength=n),
        "n_repeat_words": per_document(covered, word_edges),
    }


def band_counts(s: TextSlice, bands: Bands) -> dict[str, np.ndarray]:
    pack = zstandard.ZstdCompressor(level=bands.level).compress
    ratio, chunks, bad = np.ones(len(s)), np.zeros(len(s), np.int64), np.zeros(len(s), np.int64)
    least, most = bands.chunk_band
    for i in range(len(s)):
        text = s.text(i)
        if not text:
            continue
        ratio[i] = len(text) / len(pack(text))
        size = bands.chunk_bytes
        chunks[i] = len(text) // size
        bad[i] = sum(not least <= size / len(pack(text[k * size : (k + 1) * size])) <= most for k in range(chunks[i]))
    length = np.diff(s.edges)
    row = np.searchsorted([x[0] for x in bands.limits], length, side="right")
    low, high = np.array([x[1] for x in bands.limits]), np.array([x[2] for x in bands.limits])
    failed = (length > 0) & ((ratio < low[row]) | (ratio > high[row]) | (bad > bands.chunk_share * chunks))
    return {"zstd_ratio": ratio, "n_chunks": chunks, "n_bad_chunks": bad, "band_failed": failed}


def _judged(docs: DataFrame, bands: Bands, text: str, keep: list[str], passing: bool = False) -> DataFrame:
    """Columns ``keep`` of ``docs`` as k0, k1, ... next to the signals, or without them for the ``passing`` rows alone. A text goes to Python once."""
    sent = keep if text in keep else [*keep, text]
    at, own = sent.index(text), [f"k{i}" for i in range(len(keep))]
    names = [] if passing else [x.split()[0] for x in SIGNALS.split(", ")]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in text_slices(batch.column(at), SLICE):
                out = word_and_line_counts(s, bands.repeat_window) | band_counts(s, bands)
                words = out["n_words"]
                out["base_failed"] = (words < bands.min_words) | (100 * out["n_repeat_words"] > bands.repeat_percent * words)
                out["kept"] = ~out["base_failed"] & ~out["band_failed"]
                kept = batch.slice(s.first, len(s)).columns[: len(keep)]
                rows = pa.RecordBatch.from_arrays([*kept, *(pa.array(out[x]) for x in names)], names=[*own, *names])
                yield rows.filter(pa.array(out["kept"])) if passing else rows

    types = dict(docs.dtypes)
    schema = ", ".join([*(f"{k} {types[c]}" for k, c in zip(own, keep, strict=True)), *([] if passing else [SIGNALS])])
    return docs.select(*(F.col(c).alias(f"k{i}") for i, c in enumerate(sent))).mapInArrow(judge, schema)


def quality_signals(docs: DataFrame, bands: Bands | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The key, counts, compression ratios and verdict for every row of ``docs``.

    One pass over the text, no shuffle. A null or empty text has no words and fails the base rule; repeated
    rows and null keys are judged row by row. Other columns of ``docs`` are neither read nor returned.
    """
    return _judged(docs, bands or Bands(), text, [key]).withColumnRenamed("k0", key)


def quality_filter(docs: DataFrame, bands: Bands | None = None, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with the columns of ``docs`` whatever their names."""
    columns = docs.columns
    return _judged(docs, bands or Bands(), text, columns, passing=True).select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(columns)))
