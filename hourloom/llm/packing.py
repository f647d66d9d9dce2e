"""Packing into length buckets whose bounds minimise padding, and into batches under a token budget.

The histogram of lengths is global and has at most ``max_length`` entries, as longer texts are cut into
pieces; dynamic programming over it finds the best bounds. Inside a bucket pieces stand in seeded order. Their
ranks come from one range-partitioned sort: places inside a partition plus the counts of the partitions
before it, so a bucket may hold any part of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourloom.sources.workspace import settle

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class PackSpec:
    """Lengths in words: of a piece at most ``max_length``, of a padded batch at most ``batch_tokens``."""

    buckets: int = 16
    max_length: int = 4096
    batch_tokens: int = 65_536
    seed: int = 8


def best_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` length ranges with the least total padding; the last is the longest length.

    ``cost(i, j)``, the padding of lengths i to j in one bucket, satisfies the quadrangle inequality, so the best
    splits are monotone and each layer is found by divide and conquer.
    """
    n = len(lengths)
    if not n:
        return []
    lengths, counts = np.asarray(lengths, np.float64), np.asarray(counts, np.float64)
    number = np.concatenate([[0.0], np.cumsum(counts)])
    words = np.concatenate([[0.0], np.cumsum(counts * lengths)])
    best = lengths * number[1:] - words[1:]
    splits = []
    for _ in range(1, min(buckets, n)):
        layer, split = np.full(n, np.inf), np.zeros(n, np.int64)
        todo = [(0, n - 1, 0, n - 1)]
        while todo:
            a, b, lo, hi = todo.pop()
            if a > b:
                continue
            j = (a + b) // 2
            # the last bucket holds lengths i + 1 to j, those up to i are split best by the layer before
            i = np.arange(lo, min(hi, j) + 1)
            cost = best[i] + lengths[j] * (number[j + 1] - number[i + 1]) - (words[j + 1] - words[i + 1])
            k = int(np.argmin(cost))
            layer[j], split[j] = cost[k], i[k]
            todo += [(a, j - 1, lo, int(i[k])), (j + 1, b, int(i[k]), hi)]
        splits.append(split)
        best = layer
    bounds, j = [n - 1], n - 1
    for split in reversed(splits):
        j = int(split[j])
        bounds.append(j)
    return sorted({int(lengths[j]) for j in bounds})


def _pieces(docs: DataFrame, spec: PackSpec, id_column: str, text: str) -> DataFrame:
    """``docs`` once per piece: _piece, its _length in words and a seeded _place."""
    words = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(*(F.col(c) for c in docs.columns), words.alias("_words"), F.xxhash64(F.lit(spec.seed), F.col(id_column), F.col(text)).alias("_place"))
    rows = rows.withColumn("_piece", F.explode(F.expr(f"sequence(0L, greatest(_words - 1, 0L) div {spec.max_length}L)")))
    return rows.withColumn("_length", F.expr(f"least({spec.max_length}L, _words - _piece * {spec.max_length}L)"))


def _batched(pieces: DataFrame, lengths: DataFrame, spec: PackSpec, ties: list[str]) -> DataFrame:
    """Adds bucket_bound, batch and slot to every piece; pieces without words have none of them."""
    histogram = sorted((r["_length"], r["count"]) for r in lengths.filter("_length > 0").groupBy("_length").count().collect())
    bounds = best_bounds(np.array([x[0] for x in histogram]), np.array([x[1] for x in histogram]), spec.buckets)
    bound = F.lit(None).cast("long")
    for b in reversed(bounds):
        bound = F.when(F.col("_length") <= b, F.lit(b).cast("long")).otherwise(bound)
    rows = pieces.withColumn("bucket_bound", F.when(F.col("_length") > 0, bound))
    rows = settle(rows.orderBy("bucket_bound", "_place", *ties, "_piece").withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_at", 33).alias("_part")
    begins = rows.groupBy(part, "bucket_bound").agg(F.count("*").alias("n"), F.min("_at").alias("first"))  # partitions times buckets at most
    before = F.coalesce(F.sum("n").over(Window.partitionBy("bucket_bound").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begins = begins.select(F.col("_part").alias("_of"), F.col("bucket_bound").alias("_bound"), (before - F.col("first")).alias("_shift"))
    rank = F.col("_at") + F.col("_shift")
    capacity = F.expr(f"greatest(1L, {spec.batch_tokens}L div bucket_bound)")
    rows = rows.withColumn("_part", part).join(begins, (F.col("_part") == F.col("_of")) & F.col("bucket_bound").eqNullSafe(F.col("_bound")))
    has = F.col("bucket_bound").isNotNull()
    return rows.withColumn("batch", F.when(has, F.floor(rank / capacity))).withColumn("slot", F.when(has, F.pmod(rank, capacity)))


def pack_plan(docs: DataFrame, spec: PackSpec | None = None, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id_column, piece, first_word, length, bucket_bound, batch, slot, padding)``, a row per piece of a text.

    ``batch`` counts from 0 inside a bucket. Null and empty texts have one piece of length 0 outside all
    buckets. Rows equal in id and text are interchangeable. Only the id and lengths are shuffled.
    """
    spec = spec or PackSpec()
    narrow = settle(_pieces(docs.select(F.col(id_column), F.col(text)), spec, id_column, text).select(F.col(id_column), "_piece", "_length", "_place"), "pieces")
    rows = _batched(narrow, narrow, spec, [id_column])
    first = F.col("_piece") * spec.max_length
    return rows.select(id_column, F.col("_piece").alias("piece"), first.alias("first_word"), F.col("_length").alias("length"), "bucket_bound", "batch", "slot", (F.col("bucket_bound") - F.col("_length")).alias("padding"))


def pack(docs: DataFrame, spec: PackSpec | None = None, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``pack_plan`` with the columns of ``docs``, the text cut to the piece."""
    spec = spec or PackSpec()
    columns = docs.columns
    inner = docs.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(columns)))
    key, body = (f"c{columns.index(c)}" for c in (id_column, text))
    pieces = _pieces(inner, spec, key, body)
    lengths = settle(pieces.select("_length"), "lengths")
    at, order = columns.index(text), inner.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        word = re.compile(r"[^\x20\x09-\x0D]+")
        for batch in batches:
            texts, words, piece, length = (batch.column(i).to_pylist() for i in (at, len(order), len(order) + 1, len(order) + 2))
            for i, t in enumerate(texts):
                if words[i] > spec.max_length:
                    found = [m.span() for m in word.finditer(t)]
                    a = piece[i] * spec.max_length
                    texts[i] = t[found[a][0] : found[a + length[i] - 1][1]]
            yield batch.set_column(at, batch.schema.field(at).name, pa.array(texts, batch.schema.field(at).type))

    types = dict(pieces.dtypes)
    extra = ["_words", "_piece", "_length", "_place"]
    one_by_one = pieces.select(*order, *extra).mapInArrow(cut, ", ".join(f"{c} {types[c]}" for c in [*order, *extra]))
    rows = _batched(one_by_one, lengths, spec, [key])
    names = [F.col(f"c{i}").alias(c) for i, c in enumerate(columns)]
    return rows.select(*names, F.col("_piece").alias("piece"), F.col("_length").alias("length"), "bucket_bound", "batch", "slot", (F.col("bucket_bound") - F.col("_length")).alias("padding"))
