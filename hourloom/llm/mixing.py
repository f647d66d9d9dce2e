"""Mixing sources to target weights: equal-token blocks dealt by Sainte-Lague quotients, then chosen by seed.

Sizes are counted in words. The words of all sources are dealt anew as blocks: each source gets blocks by
highest quotients of its target, each shard of a source gets some of these by highest quotients of its
words. A shard's documents stand in seeded order and are cut into blocks of equal size; a seeded permutation
says which blocks are taken once more than the others. So a document's share follows from its place in its
shard alone, and no shard is larger than a task can sort.
"""

from __future__ import annotations

import heapq
import math
import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourloom.sources.workspace import settle

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class MixSpec:
    """``weights`` repeat over the sources in code point order, null last; ``most`` bounds a target in source sizes.

    ``shard_words`` sets the number of shards, up to ``max_shards`` per source. ``max_sources`` is checked:
    the list of sources, one row each, is dealt on the driver.
    """

    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    most: int = 3
    block_words: int = 64
    shard_words: int = 131_072
    max_shards: int = 16_384
    max_sources: int = 100_000
    seed: int = 20


def capped_targets(sizes: list[int], weights: list[float], most: int) -> list[float]:
    """Shares of ``sum(sizes)`` by weight; what exceeds ``most`` times a size is shared again until nothing does."""
    total = float(sum(sizes))
    out, free = [0.0] * len(sizes), [i for i, s in enumerate(sizes) if s > 0]
    left = total
    while free:
        weight = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / weight > most * sizes[i]]
        if not over:
            for i in free:
                out[i] = left * weights[i] / weight
            break
        for i in over:
            out[i] = float(most * sizes[i])
        left = total - sum(out)
        free = [i for i in free if not out[i]]
    return out


def sainte_lague(votes: np.ndarray, seats: int, limits: np.ndarray) -> np.ndarray:
    """Seats by the highest quotients ``votes / (2 k + 1)``, no party above its limit; ties go to the earlier party.

    A divisor found by bisection gives most seats at once, the heap of quotients the rest, so the cost
    grows with the parties and not with the seats.
    """
    votes, limits = np.asarray(votes, float), np.asarray(limits, np.int64)
    seats = int(min(seats, limits[votes > 0].sum()))
    given = np.zeros(len(votes), np.int64)
    if seats <= 0:
        return given
    rounded = lambda d: np.minimum(np.floor(votes / d + 0.5), limits).astype(np.int64)
    low, high = votes.max() / (2.0 * seats + 2.0) / 4, 2.0 * votes.max() + 1.0
    while rounded(low).sum() < seats:
        low /= 2
    for _ in range(200):
        middle = (low + high) / 2
        if rounded(middle).sum() > seats:
            low = middle
        else:
            high = middle
    given = rounded(high * (1 + 1e-12))
    heap = [(-votes[i] / (2 * given[i] + 1), i) for i in range(len(votes)) if given[i] < limits[i] and votes[i] > 0]
    heapq.heapify(heap)
    for _ in range(seats - int(given.sum())):
        _, i = heapq.heappop(heap)
        given[i] += 1
        if given[i] < limits[i]:
            heapq.heappush(heap, (-votes[i] / (2 * given[i] + 1), i))
    return given


def _sized(docs: DataFrame, spec: MixSpec, id_column: str, source: str, text: str) -> DataFrame:
    """``docs`` with its size, a source key without nulls and a seeded place."""
    return docs.select(
        *(F.col(c) for c in docs.columns),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("_size"),
        F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("n")).alias("_source"),
        F.xxhash64(F.lit(spec.seed), F.col(id_column), F.col(text)).alias("_place"),
    )


def _shards(total: int, spec: MixSpec) -> int:
    return max(1, min(spec.max_shards, math.ceil(total / spec.shard_words)))


def quotas(sizes: DataFrame, spec: MixSpec) -> tuple[DataFrame, int]:
    """Blocks of every (source, shard) and how many of them the mix takes; the number of shards. ``sizes``: _source, _place, _size."""
    spark = sizes.sparkSession
    rows = sizes.groupBy("_source").agg(F.sum("_size").alias("size")).limit(spec.max_sources + 1).collect()
    if len(rows) > spec.max_sources:
        raise ValueError(f"more than {spec.max_sources} sources")
    rows = sorted(rows, key=lambda r: (r["_source"] == "n", r["_source"]))
    names, words = [r["_source"] for r in rows], [int(r["size"]) for r in rows]
    targets = capped_targets(words, [spec.weights[i % len(spec.weights)] for i in range(len(rows))], spec.most)
    total = sum(words)
    shards = _shards(total, spec)
    seats = sainte_lague(np.array(targets), round(total / spec.block_words), np.array([spec.most * max(1, -(-w // spec.block_words) + shards) for w in words])) if total else [0] * len(rows)
    per_source = spark.createDataFrame([(n, w, float(t), int(s)) for n, w, t, s in zip(names, words, targets, seats, strict=True)], "_source string, source_size long, target double, seats long")

    def deal(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_shard", ignore_index=True)
        words = group["words"].to_numpy(np.int64)
        blocks = np.where(words > 0, np.maximum(1, np.rint(words / spec.block_words)), 0).astype(np.int64)
        given = sainte_lague(words.astype(float), int(group["seats"].iloc[0]), spec.most * blocks)
        step, shift = [], []
        for shard, n in zip(group["_shard"], blocks, strict=True):
            rng = random.Random(f"{spec.seed}/{group['_source'].iloc[0]}/{shard}")
            a = rng.randrange(1, max(2, n))
            while math.gcd(a, max(1, int(n))) != 1:
                a = rng.randrange(1, max(2, n))
            step.append(a)
            shift.append(rng.randrange(max(1, n)))
        return pd.DataFrame({"_source": group["_source"], "_shard": group["_shard"], "words": words, "blocks": blocks, "quota": given, "step": step, "shift": shift, "source_size": group["source_size"], "target": group["target"]})

    dealt = sizes.groupBy("_source", F.pmod("_place", F.lit(shards)).alias("_shard")).agg(F.sum("_size").alias("words")).join(per_source, "_source")
    schema = "_source string, _shard long, words long, blocks long, quota long, step long, shift long, source_size long, target double"
    return settle(dealt.groupBy("_source").applyInPandas(deal, schema), "quotas"), shards


def _placed(rows: DataFrame, plan: DataFrame, shards: int, id_column: str) -> DataFrame:
    """``rows`` with the blocks of their shard and ``taken``, the words of them that the mix takes."""
    order = Window.partitionBy("_source", "_shard").orderBy("_place", id_column, "_size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_shard", F.pmod("_place", F.lit(shards))).withColumn("_end", F.sum("_size").over(order)).join(plan, ["_source", "_shard"])
    # block b of n covers words floor(b w / n) to floor((b + 1) w / n); blocks are chosen where (step b + shift) mod n is small
    extra = F.expr(
        """aggregate(
            sequence(((_end - _size + 1) * blocks - 1) div words, (_end * blocks - 1) div words), 0L,
            (sum, b) -> sum + if((step * b + shift) % blocks < quota % blocks,
                least(_end, ((b + 1) * words) div blocks) - greatest(_end - _size, (b * words) div blocks), 0L))"""
    )
    return rows.withColumn("taken", F.when(F.col("_size") > 0, F.expr("quota div blocks") * F.col("_size") + extra).otherwise(F.lit(0)).cast("long"))


def mix_report(docs: DataFrame, spec: MixSpec | None = None, id_column: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """``(id_column, size, source_size, target, taken)`` for every row of ``docs``; reruns agree.

    Null and empty texts have size 0 and nothing is taken of them. A null source is a source of its own, the
    last one. Rows that are equal in id and text are interchangeable: which of them has which share is open. Other
    columns are not read, and an empty table has no rows.
    """
    spec = spec or MixSpec()
    inner = docs.select(F.col(id_column).alias("c0"), F.col(source).alias("c1"), F.col(text).alias("c2"))
    rows = settle(_sized(inner, spec, "c0", "c1", "c2").select("c0", "_size", "_source", "_place"), "sizes")
    plan, shards = quotas(rows, spec)
    return _placed(rows, plan, shards, "c0").select(F.col("c0").alias(id_column), F.col("_size").alias("size"), "source_size", "target", "taken")


def mix(docs: DataFrame, spec: MixSpec | None = None, id_column: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The mixed corpus: ``docs`` with one row per copy, its text cut to the words of the chosen blocks.

    Columns are those of ``docs``. Pieces of one copy that do not touch are joined by a line feed.
    """
    spec = spec or MixSpec()
    columns = docs.columns
    inner = docs.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(columns)))
    name = {c: f"c{i}" for i, c in enumerate(columns)}
    rows = _sized(inner, spec, name[id_column], name[source], name[text])
    plan, shards = quotas(settle(rows.select("_size", "_source", "_place"), "sizes"), spec)
    placed = _placed(rows, plan, shards, name[id_column]).filter("taken > 0")
    at = columns.index(text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        word = re.compile(r"[^\x20\x09-\x0D]+")
        for batch in batches:
            texts = batch.column(at).to_pylist()
            end, size, words, blocks, quota, step, shift = (batch.column(len(columns) + i).to_pylist() for i in range(7))
            pick, out = [], []
            for i, t in enumerate(texts):
                begin, full, part = end[i] - size[i], quota[i] // blocks[i], quota[i] % blocks[i]
                chosen = [b for b in range(((begin + 1) * blocks[i] - 1) // words[i], (end[i] * blocks[i] - 1) // words[i] + 1) if (step[i] * b + shift[i]) % blocks[i] < part]
                out += [t] * full
                pick += [i] * full
                if chosen:
                    spans = []
                    for b in chosen:
                        x, y = max(begin, b * words[i] // blocks[i]) - begin, min(end[i], (b + 1) * words[i] // blocks[i]) - begin
                        if spans and spans[-1][1] == x:
                            spans[-1][1] = y
                        else:
                            spans.append([x, y])
                    if spans == [[0, size[i]]]:
                        piece = t
                    else:
                        found = [m.span() for m in word.finditer(t)]
                        piece = "\n".join(t[found[x][0] : found[y - 1][1]] for x, y in spans if y > x)
                    out.append(piece)
                    pick.append(i)
            rows = batch.select(list(range(len(columns)))).take(pa.array(pick, pa.int64()))
            yield rows.set_column(at, rows.schema.field(at).name, pa.array(out, rows.schema.field(at).type))

    types = dict(inner.dtypes)
    out = placed.select(*inner.columns, "_end", "_size", "words", "blocks", "quota", "step", "shift").mapInArrow(cut, ", ".join(f"{c} {types[c]}" for c in inner.columns))
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(columns)))
