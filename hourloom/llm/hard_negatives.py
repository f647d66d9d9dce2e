"""Hard negatives by an inverted multi-index whose search stops when its answer is certain.

1. Vectors are whole numbers, ``floor(scale * x)``. Two codebooks, one for either half of the components, are fitted on a bounded
   sample; a vector's cell is its pair of nearest codewords. Every vector is indexed: sorted by cell, cells in regions, regions in
   salts of bounded size, in blocks of rows. The driver sees one row a cell: its number of vectors and its two radii.
2. An anchor's product with a half is at most its product with the codeword plus its norm times the codeword's radius. A heap walks
   through cells by the sum of both bounds (multi-sequence), in rounds of growing numbers of vectors; what an anchor wants to
   see of a region travels as one bit a cell, anchors meet the blocks of a region in one join, exact products come back as few best rows.
3. Positives are certain when the last of them beats the bound of the next cell. Then each positive has its window of scores, and the
   walk starts again for negatives: cells wholly above the windows are passed over, and an anchor is done when each window is full with
   scores above the next bound, or when that bound lies below the window.

Results are exact whatever the sample, as radii are those of all vectors. No cap is set: an uncertain anchor goes on until it has seen every cell.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourloom.llm.workers import records_per_batch
from hourloom.sources.workspace import settle


@dataclass(frozen=True)
class MiningSpec:
    """``least_percent``: of a positive's score that its negatives have. ``sample``: vectors that codebooks of ``codewords`` are fitted on; at most 64 cells a region (``codewords ** 2 / regions``).

    ``first_rows`` vectors are seen in the first round, ``growth`` times as many in each further one.
    """

    positives: int = 5
    negatives: int = 5
    least_percent: int = 80
    scale: int = 256
    sample: int = 8_192
    codewords: int = 32
    regions: int = 16
    sweeps: int = 6
    first_rows: int = 4_096
    growth: int = 16
    block_rows: int = 1_024
    region_rows: int = 1 << 20
    anchor_rows: int = 256
    seed: int = 17


_LONG = np.iinfo(np.int64)


# --- vectors -----------------------------------------------------------------------------


def _whole(batches: Iterator[pa.RecordBatch], dims: int, scale: int) -> Iterator[pa.RecordBatch]:
    """Whole-number vectors, zeros beyond a shorter one's end; two bytes a component where they fit, else eight."""
    for batch in batches:
        column = batch.column(2)
        values = column.flatten()
        bad = np.asarray(values.is_null())
        x = values.to_numpy(zero_copy_only=False).astype(np.float64)
        bad = bad | ~np.isfinite(x)
        x = np.where(bad, 0.0, x)
        size = np.diff(column.offsets.to_numpy())
        row = np.repeat(np.arange(len(size)), size)
        good = np.bincount(row[bad], minlength=len(size)) == 0
        with np.errstate(over="ignore"):
            q = np.clip(np.floor(scale * x), -np.finfo(float).max, np.finfo(float).max)
        matrix = np.zeros((len(size), dims))
        matrix[row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)] = q
        small = (np.abs(matrix) < 32768).all(axis=1) if dims else np.ones(len(size), bool)
        bodies = [(m.astype(np.int16) if s else m).tobytes() for m, s in zip(matrix, small, strict=True)]
        keep = pa.array(good)
        yield pa.RecordBatch.from_arrays([c.filter(keep) for c in (batch.column(0), batch.column(1), pa.array(bodies, pa.binary()), batch.column(3))], names=["id", "label", "q", "anchor"])


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of bodies, or the rows of packed ones, as doubles."""
    bodies = column.to_pylist()
    return np.concatenate([_unpacked(b, dims) for b in bodies]) if bodies else np.zeros((0, dims))


def _unpacked(body: bytes, dims: int, rows: int = 1) -> np.ndarray:
    kind = np.int16 if len(body) == 2 * dims * rows else np.float64
    return np.frombuffer(body, kind).reshape(rows, dims).astype(np.float64)


def _packed(bodies: list[bytes], dims: int) -> bytes:
    if all(len(b) == 2 * dims for b in bodies):
        return b"".join(bodies)
    return np.concatenate([_unpacked(b, dims) for b in bodies]).tobytes()


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-number rows, kept within the range of a long."""
    top = (np.abs(a).max() if a.size else 0) * (np.abs(b).max() if b.size else 0) * max(1, a.shape[1])
    if top < 2**24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if top < 2**53:
        return (a @ b.T).astype(np.int64)
    exact = np.vectorize(int, otypes=[object])
    found = exact(a) @ exact(b).T
    return np.clip(found, _LONG.min, _LONG.max).astype(np.int64)


# --- index --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Codebooks:
    """Codewords of both halves of ``dims`` components."""

    first: np.ndarray
    second: np.ndarray
    dims: int

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, : self.dims // 2], x[:, self.dims // 2 :]


def _nearest(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.argmin((words * words).sum(1)[None, :] - 2 * (x @ words.T), axis=1)


def fit_codebooks(sample: np.ndarray, spec: MiningSpec) -> Codebooks:
    """Lloyd sweeps over each half of the sampled vectors from random different ones; both books have ``codewords`` rows."""
    rng, dims = np.random.default_rng(spec.seed), sample.shape[1]
    books = []
    for x in (sample[:, : dims // 2], sample[:, dims // 2 :]):
        seen = np.unique(x, axis=0)
        words = seen[rng.permutation(len(seen))[: spec.codewords]]
        words = np.concatenate([words, np.repeat(words[:1], spec.codewords - len(words), axis=0)])
        for _ in range(spec.sweeps):
            at = _nearest(x, words)
            n = np.bincount(at, minlength=spec.codewords)
            sums = np.zeros_like(words)
            np.add.at(sums, at, x)
            words = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], words)
        books.append(words)
    return Codebooks(*books, dims)


def _placed(batches: Iterator[pa.RecordBatch], books: Codebooks, spec: MiningSpec) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = books.halves(_matrix(batch.column(2), books.dims))
        at = [_nearest(h, w) for h, w in zip(x, (books.first, books.second), strict=True)]
        away = [np.sqrt(((h - w[i]) ** 2).sum(1)) for h, w, i in zip(x, (books.first, books.second), at, strict=True)]
        cell = (at[0] * spec.codewords + at[1]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(away[0]), pa.array(away[1])], names=["id", "label", "q", "anchor", "cell", "r1", "r2"])


def _block_rows(batches: Iterator[pa.RecordBatch], dims: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows ``region, salt, cell, id, label, q`` in blocks of one region and salt; equal neighbours only once."""
    held, last, where = [], None, None

    def block():
        cells, ids, labels, bodies = zip(*held, strict=True)
        packed = [np.array(cells, np.int32).tobytes(), np.array(ids, np.int64).tobytes(), np.array(labels, np.int64).tobytes(), _packed(list(bodies), dims)]
        return pa.RecordBatch.from_arrays(
            [pa.array([where[0]], pa.int32()), pa.array([where[1]], pa.int32()), *(pa.array([x], pa.binary()) for x in packed)], names=["region", "salt", "cells", "ids", "labels", "rows"]
        )

    for batch in batches:
        for region, salt, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and ((region, salt) != where or len(held) == limit):
                yield block()
                held = []
            if (region, salt) != where or row != last:
                held.append(row)
            where, last = (region, salt), row
    if held:
        yield block()


# --- visits -------------------------------------------------------------------------------


@dataclass(frozen=True)
class _Index:
    """What the driver knows: codebooks, a radius for each codeword, the number of vectors of each cell."""

    books: Codebooks
    radii: tuple[np.ndarray, np.ndarray]
    counts: np.ndarray

    def bounds(self, q: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each half the largest and least product that the vectors of each codeword can have."""
        out = []
        for half, words, radius in zip(self.books.halves(q), (self.books.first, self.books.second), self.radii, strict=True):
            middle, reach = half @ words.T, np.sqrt((half * half).sum(1))[:, None] * radius[None, :]
            slack = 1.0 + 1e-9 * (np.abs(middle) + reach)
            out.append((middle + reach + slack, middle - reach - slack))
        return out


def multi_sequence(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """Pairs of both sequences by falling sums."""
    order1, order2 = np.argsort(-first, kind="stable").tolist(), np.argsort(-second, kind="stable").tolist()
    x, y = first[order1].tolist(), second[order2].tolist()
    heap = [(-(x[0] + y[0]), 0, 0)]
    while heap:
        bound, i, j = heapq.heappop(heap)
        yield -bound, order1[i], order2[j]
        if j + 1 < len(y):
            heapq.heappush(heap, (-(x[i] + y[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(x):
            heapq.heappush(heap, (-(x[i + 1] + y[0]), i + 1, 0))


def _plan(batches: Iterator[pa.RecordBatch], index: _Index, spec: MiningSpec, rows: int) -> Iterator[pa.RecordBatch]:
    """For each anchor the cells of this round, as a bit mask a region, the cells passed so far and the bound of the next one.

    ``low`` and ``high`` are the least and largest score that still matter.
    """
    per_region = spec.codewords**2 // spec.regions
    for batch in batches:
        q = _matrix(batch.column(3), index.books.dims)
        (up1, down1), (up2, down2) = index.bounds(q)
        passed, low, high = (batch.column(i).to_numpy() for i in (4, 5, 6))
        masks, now, bounds = np.zeros((len(q), spec.regions), np.uint64), passed.copy(), np.full(len(q), -np.inf)
        for k in range(len(q)):
            seen = 0
            for place, (bound, i, j) in enumerate(multi_sequence(up1[k], up2[k])):
                if place < passed[k]:
                    continue
                if bound < low[k]:
                    break
                if seen >= rows:
                    bounds[k] = bound
                    break
                now[k] = place + 1
                cell = i * spec.codewords + j
                if index.counts[cell] and down1[k, i] + down2[k, j] <= high[k]:
                    seen += index.counts[cell]
                    masks[k, cell // per_region] |= np.uint64(1) << np.uint64(cell % per_region)
        flat = pa.array(masks.view(np.int64).ravel())
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(q) + 1, dtype=np.int32) * spec.regions), flat)
        out = [*batch.columns[:4], pa.array(now), batch.column(5), batch.column(6), batch.column(7), lists, pa.array(bounds)]
        yield pa.RecordBatch.from_arrays(out, names=["a", "id", "label", "q", "passed", "low", "high", "windows", "masks", "bound"])


_STATE = "a long, id long, label long, q binary, passed long, low double, high double, windows array<long>"


def _requests(batches: Iterator[pa.RecordBatch], spec: MiningSpec, dims: int) -> Iterator[pa.RecordBatch]:
    """What the anchors of a batch want to see of each region, some anchors a row."""
    names = ["region", "anchors", "own", "own_labels", "vectors", "masks", "windows"]
    for batch in batches:
        masks = batch.column(8).flatten().to_numpy().reshape(-1, spec.regions)
        a, own, labels = (batch.column(i).to_numpy() for i in range(3))
        bodies, windows = batch.column(3).to_pylist(), batch.column(7).to_pylist()
        for region in range(spec.regions):
            wanted = np.flatnonzero(masks[:, region])
            for at in range(0, len(wanted), spec.anchor_rows):
                use = wanted[at : at + spec.anchor_rows]
                packed = [a[use].tobytes(), own[use].tobytes(), labels[use].tobytes(), _packed([bodies[i] for i in use], dims), masks[use, region].tobytes(), np.array([windows[i] for i in use], np.int64).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([region], pa.int32()), *(pa.array([x], pa.binary()) for x in packed)], names=names)


def _best(score: np.ndarray, valid: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the k best valid scores of each row, ties by id."""
    row, col = np.nonzero(valid)
    value = score[row, col]
    full = np.bincount(row, minlength=len(score))
    if full.max(initial=0) > 4 * k:  # thin out first: what is below a row's k-th score cannot be among its best
        ranked = np.where(valid, score, _LONG.min)
        floor = np.partition(ranked, ranked.shape[1] - k, axis=1)[:, -k]
        keep = value >= floor[row]
        row, col, value = row[keep], col[keep], value[keep]
    order = np.lexsort((ids[col], -value, row))
    row, col = row[order], col[order]
    begin = np.searchsorted(row, np.arange(len(score)))
    keep = np.arange(len(row)) - begin[row] < k
    return row[keep], col[keep]


def _scores(batches: Iterator[pa.RecordBatch], spec: MiningSpec, dims: int, k: int) -> Iterator[pa.RecordBatch]:
    """The best rows of a block for each anchor of a request: of its own label where it has no windows, else in each window."""
    per_region = spec.codewords**2 // spec.regions
    for batch in batches:
        for region, *bodies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            a, own, own_labels = (np.frombuffer(b, np.int64) for b in bodies[:3])
            masks, windows = np.frombuffer(bodies[4], np.uint64), np.frombuffer(bodies[5], np.int64).reshape(len(a), -1)
            cells, ids, labels = np.frombuffer(bodies[6], np.int32), np.frombuffer(bodies[7], np.int64), np.frombuffer(bodies[8], np.int64)
            local = (cells - region * per_region).astype(np.uint64)
            open_ = ((masks[:, None] >> local[None, :]) & np.uint64(1)).astype(bool)
            rows = np.flatnonzero(open_.any(axis=0))
            if not len(rows):
                continue
            open_, ids, labels = open_[:, rows], ids[rows], labels[rows]
            score = products(_unpacked(bodies[3], dims, len(a)), _unpacked(bodies[9], dims, len(cells))[rows])
            same = own_labels[:, None] == labels[None, :]
            if windows.shape[1] == 0:
                found = [(0, *_best(score, open_ & same & (own[:, None] != ids[None, :]), ids, min(k, len(ids))))]
            else:
                other = open_ & ~same
                found = []
                for slot in range(windows.shape[1]):
                    top = windows[:, slot]
                    fits = other & (score <= top[:, None]) & (score >= _floor(top, spec.least_percent)[:, None])
                    found.append((slot, *_best(score, fits, ids, min(k, len(ids)))))
            slots = np.concatenate([np.full(len(r), s) for s, r, _ in found])
            row, col = (np.concatenate([x[i] for x in found]) for i in (1, 2))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (a[row], slots.astype(np.int32), score[row, col], ids[col])], names=["a", "slot", "score", "id"])


def _floor(top: np.ndarray, percent: int) -> np.ndarray:
    """The least whole number of at least ``percent`` of each, without overflow; above ``top`` itself where that is negative."""
    return percent * (top // 100) - (-(percent * (top % 100)) // 100)


# --- search ---------------------------------------------------------------------------------


def _top(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("a", "slot").orderBy(F.desc("score"), "id")
    return rows.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


class _Search:
    """Rounds of visits until every anchor is certain."""

    def __init__(self, blocks: DataFrame, salts: list[int], index: _Index, spec: MiningSpec):
        self.blocks, self.index, self.spec = blocks, index, spec
        self.salts = F.element_at(F.array(*[F.lit(n) for n in salts]), F.col("region") + 1)

    def _visit(self, states: DataFrame, k: int, rows: int) -> tuple[DataFrame, DataFrame]:
        """The plan of a round, and its best rows."""
        spec, index, dims = self.spec, self.index, self.index.books.dims
        plan = settle(states.mapInArrow(lambda x: _plan(x, index, spec, rows), _STATE + ", masks array<long>, bound double"), "visits")
        request = "region int, anchors binary, own binary, own_labels binary, vectors binary, masks binary, windows binary"
        wanted = plan.mapInArrow(lambda x: _requests(x, spec, dims), request)
        wanted = wanted.withColumn("salt", F.explode(F.sequence(F.lit(0), self.salts - 1)))
        met = wanted.join(self.blocks, ["region", "salt"])
        met = met.select("region", "anchors", "own", "own_labels", "vectors", "masks", "windows", "cells", "ids", "labels", "rows")
        found = _top(met.mapInArrow(lambda x: _scores(x, spec, dims, k), "a long, slot int, score long, id long"), k)
        with records_per_batch(plan.sparkSession, 64):  # a row holds a block and its anchors
            return plan, settle(found.drop("place"), "scores")

    def run(self, states: DataFrame, k: int, floors: DataFrame | None) -> DataFrame:
        """``(a, slot, score, id, place)``: the best k rows of each anchor and slot; ``floors`` has the least score of each slot."""
        best, rows = None, self.spec.first_rows
        while True:
            plan, found = self._visit(states, k, rows)
            best = settle(_top(found if best is None else best.drop("place").unionByName(found), k), "best")
            full = best.groupBy("a", "slot").agg(F.count("*").alias("n"), F.min("score").alias("last"))
            full = full.filter(F.col("n") >= k).select("a", "slot", "last")
            if floors is None:
                at = plan.join(full, "a", "left")
                states = at.filter(~_certain(F.lit(None))).select(*plan.columns[:8])
            else:
                slots = floors.join(full, ["a", "slot"], "left")
                at = plan.join(slots, "a").filter(~_certain(F.col("floor")))
                still = at.groupBy("a").agg(F.collect_list(F.struct("slot", "top", "floor")).alias("open"))
                states = plan.drop("low", "high", "windows").join(still, "a").select(
                    "a", "id", "label", "q", "passed",
                    F.array_min(F.transform("open", lambda o: o["floor"])).cast("double").alias("low"),
                    F.array_max(F.transform("open", lambda o: o["top"])).cast("double").alias("high"),
                    _windows(F.map_from_entries(F.transform("open", lambda o: F.struct(o["slot"], o["top"]))), self.spec).alias("windows"),
                )
            states = settle(states, "open")
            if states.isEmpty():
                return best
            rows *= self.spec.growth


def _windows(tops: Column, spec: MiningSpec) -> Column:
    """The positive's score of each slot; a score that no window reaches down from where a slot is closed."""
    return F.array(*[F.coalesce(F.try_element_at(tops, F.lit(i)), F.lit(_LONG.min)) for i in range(spec.positives)])


def _certain(floor: Column) -> Column:
    """Nothing that was not visited can change the answer: it is full and beats the next bound, or no cell is left above the window.

    Walks end with the bound -infinity when cells or windows do.
    """
    bound = F.col("bound")
    return F.coalesce(F.col("last") > bound, F.lit(False)) | (bound == F.lit(float("-inf"))) | F.coalesce(floor.cast("double") > bound, F.lit(False))


def mine(vectors: DataFrame, anchor: Column | str, spec: MiningSpec | None = None, id_column: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` for the rows where ``anchor`` is true.

    An anchor's positives are its best rows of the same label, a positive's negatives the best rows of other labels with a score between
    ``least_percent`` of the positive's and the positive's own; scores are inner products, higher ones first, ties by smaller id.
    Rows with a null id, label or vector, or a null, infinite or NaN component take no part. Equal rows count once; different rows with one id
    are not each other's partners. A shorter vector has zeros at its end. Scores beyond a long are its bounds. Anchors without positives
    or negatives have no rows; an empty table has none. Other columns are not read.
    """
    spec = spec or MiningSpec()
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    condition = F.expr(anchor) if isinstance(anchor, str) else anchor
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("x"), F.coalesce(condition, F.lit(False)).alias("anchor"))
    rows = rows.filter("id is not null and label is not null and x is not null")
    dims = max(1, rows.agg(F.max(F.size("x"))).first()[0] or 0)
    whole = rows.mapInArrow(lambda x: _whole(x, dims, spec.scale), "id long, label long, q binary, anchor boolean")
    sample = whole.orderBy(F.xxhash64("id", F.lit(spec.seed)), "id").limit(spec.sample).select("q").toArrow().column("q").combine_chunks()
    if not len(sample):
        return vectors.sparkSession.createDataFrame([], result)
    books = fit_codebooks(_matrix(sample, dims), spec)
    placed = settle(whole.mapInArrow(lambda x: _placed(x, books, spec), "id long, label long, q binary, anchor boolean, cell int, r1 double, r2 double"), "placed")

    per_region = spec.codewords**2 // spec.regions
    counts, radii = np.zeros(spec.codewords**2, np.int64), (np.zeros(spec.codewords), np.zeros(spec.codewords))
    for cell, n, r1, r2 in placed.groupBy("cell").agg(F.count("*"), F.max("r1"), F.max("r2")).collect():  # at most codewords ** 2 rows
        counts[cell] = n
        for radius, word, r in zip(radii, divmod(cell, spec.codewords), (r1, r2), strict=True):
            radius[word] = max(radius[word], r)
    index = _Index(books, radii, counts)
    salts = [max(1, -(-int(n) // spec.region_rows)) for n in counts.reshape(spec.regions, -1).sum(axis=1)]

    located = placed.select((F.col("cell") / per_region).cast("int").alias("region"), "cell", "id", "label", "q")
    of_region = F.element_at(F.array(*[F.lit(n) for n in salts]), F.col("region") + 1)
    located = located.withColumn("salt", F.pmod(F.xxhash64("id"), of_region).cast("int"))
    order = ["region", "salt", "cell", "id", "label", "q"]
    blocks = located.select("region", "salt", "cell", "id", "label", "q").repartition("region", "salt").sortWithinPartitions(*order)
    blocks = settle(blocks.mapInArrow(lambda x: _block_rows(x, dims, spec.block_rows), "region int, salt int, cells binary, ids binary, labels binary, rows binary"), "blocks")

    anchors = placed.filter("anchor").dropDuplicates(["id", "label", "q"]).repartitionByRange("cell", "id")
    zero, far = F.lit(0).cast("long"), F.lit(float("inf"))
    states = anchors.select(F.monotonically_increasing_id().alias("a"), "id", "label", "q", zero.alias("passed"), (-far).alias("low"), far.alias("high"), F.array().cast("array<long>").alias("windows"))
    states = settle(states, "anchors")
    if states.isEmpty():
        return vectors.sparkSession.createDataFrame([], result)
    search = _Search(blocks, salts, index, spec)

    positives = search.run(states, spec.positives, None)
    pairs = positives.select("a", (F.col("place") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("top"))
    percent = F.lit(spec.least_percent)
    floor = percent * F.expr("top div 100") + F.ceil(percent * (F.col("top") % 100) / F.lit(100))
    floors = settle(pairs.filter("top >= 0").select("a", "slot", "top", floor.cast("long").alias("floor")), "windows")
    wide = floors.groupBy("a").agg(F.min("floor").alias("low"), F.max("top").alias("high"), F.map_from_entries(F.collect_list(F.struct("slot", "top"))).alias("tops"))
    ready = states.drop("low", "high", "windows").join(wide, "a").select("a", "id", "label", "q", "passed", F.col("low").cast("double"), F.col("high").cast("double"), _windows(F.col("tops"), spec).alias("windows"))
    negatives = search.run(settle(ready, "ready"), spec.negatives, floors)

    out = negatives.select("a", "slot", F.col("place").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    out = out.join(pairs, ["a", "slot"]).join(states.select("a", F.col("id").alias("anchor_id")), "a")
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int"), "negative_id", F.col("top").alias("positive_score"), "negative_score")
