"""Near duplicates: an inverted join over MinHash signature coordinates, confirmed on whole shingle sets.

1. Every text becomes its set of distinct word shingles (64-bit hashes) and a signature of minima. Texts
   with equal sets are one class; only classes are joined.
2. A linked pair agrees in at least ``least_shared`` of the first ``posted`` coordinates (but for a chance of
   2e-7 at the bound of similarity), so it shares one of the ``posted - least_shared + 1`` rarest (coordinate,
   value) pairs of either class. Only that prefix is posted: values that a frequent line or passage brings
   are skipped unless they make up most of a text.
3. Star rounds compare each class with one head of every list it is in, keep the heads with most equal
   coordinates, and confirm those pairs. Groups of copies collapse here with a number of pairs that grows
   with their size, not its square.
4. Lists that still hold several components get a centre, their member with most links, and every member its
   delta, the shingles that it and the centre do not share. Members close enough to the list's hub are linked with
   it by the sizes of their deltas alone. For all others pairs are sought by an inverted join over the rarest items of
   their deltas, of which two linked sets share more the farther they are from the centre: members that only differ
   from the centre, each in its own way, meet nobody. No list is cut and no pair that can be linked is dropped.
5. These pairs are confirmed by intersecting whole sets: a few of each two components first, the others where none
   of these was linked. Pairs of a star round with too few equal coordinates in the whole signature (a chance
   of 1e-7 for a linked pair) are not confirmed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourloom.llm.graph import connected_components
from hourloom.llm.textbytes import TextSlice, mixed, owners, text_slices, windows
from hourloom.llm.workers import records_per_batch
from hourloom.sources.workspace import settle, settle_narrow

_U = np.uint64
SLICE = 1 << 18  # bytes of text that a worker turns into sets at once
BLOCK, BLOCKS = 1 << 15, 1 << 10  # bits of one of Spark's bitmaps, and how many of them a filter has at most


@dataclass(frozen=True)
class NearSpec:
    """``percent``: least similarity. ``coordinates`` of a signature, the first ``posted`` of which are joined on."""

    words: int = 5
    percent: int = 80
    coordinates: int = 64
    posted: int = 32
    least_shared: int = 13
    match_threshold: int = 33
    star_rounds: int = 1
    heads: int = 2
    tries: int = 4


def shingle_sets(s: TextSlice, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document, and the documents' edges among them.

    A document with fewer words than a shingle has its whole sequence as the only one.
    """
    words, edges = s.words(lower=True)
    found, start = windows(words, edges, width)
    doc = owners(edges)[start]
    n = np.diff(edges)
    short = np.flatnonzero((n > 0) & (n < width))
    whole = np.zeros(len(short), np.uint64)
    for k in range(width - 1):
        has = n[short] > k
        whole[has] = whole[has] * _U(0x9E3779B97F4A7C15) + words[edges[short[has]] + k]
    found = np.concatenate([found, mixed(whole + _U(1))])
    doc = np.concatenate([doc, short])
    order = np.lexsort((found, doc))
    found, doc = found[order], doc[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (doc[1:] != doc[:-1])
    return found[new], np.searchsorted(doc[new], np.arange(len(s) + 1))


def signatures(sets: np.ndarray, edges: np.ndarray, coordinates: int) -> np.ndarray:
    """Minima of ``coordinates`` hash orders over every non-empty set, one row per document; empty sets have zeros."""
    out = np.zeros((len(edges) - 1, coordinates), np.uint32)
    full = np.flatnonzero(np.diff(edges))
    if not len(full):
        return out
    odd = mixed(np.arange(1, coordinates + 1, dtype=np.uint64)) | _U(1)
    flip = mixed(np.arange(1001, coordinates + 1001, dtype=np.uint64))
    for k in range(coordinates):
        out[full, k] = np.minimum.reduceat((sets ^ flip[k]) * odd[k], edges[full]) >> _U(32)
    return out


def _sums(sets: np.ndarray, edges: np.ndarray, seed: int) -> np.ndarray:
    total = np.concatenate([[_U(0)], np.cumsum(mixed(sets ^ _U(seed)))])
    return (total[edges[1:]] - total[edges[:-1]]).view(np.int64)


def _sketches(batches: Iterator[pa.RecordBatch], spec: NearSpec) -> Iterator[pa.RecordBatch]:
    names = ["id", "hash", "n_shingles", "h1", "h2", "sig"]
    for batch in batches:
        for s in text_slices(batch.column(1), SLICE):
            sets, edges = shingle_sets(s, spec.words)
            sig = signatures(sets, edges, spec.coordinates)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(s.first, len(s)), batch.column(2).slice(s.first, len(s)),
                    pa.array(np.diff(edges)), pa.array(_sums(sets, edges, 0x5EED)), pa.array(_sums(sets, edges, 0xFACE)),
                    pa.array([x.tobytes() for x in sig], pa.binary()),
                ],
                names=names,
            )


def _each_set(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The shingle set of every text of a column; sets of one slice of it are held at a time."""
    for s in text_slices(column, SLICE):
        sets, edges = shingle_sets(s, width)
        yield from (sets[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True))


def _matrix(column: pa.Array, coordinates: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, coordinates)


def _postings(sigs: DataFrame, spec: NearSpec) -> DataFrame:
    """``(key, id)`` for the rarest coordinate values of each class, so far as another class has them too."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = mixed(np.arange(1, spec.posted + 1, dtype=np.uint64))
        for batch in batches:
            if batch.num_rows:
                values = _matrix(batch.column(1), spec.coordinates)[:, : spec.posted].astype(np.uint64)
                keys = mixed(values ^ salt)
                ids = np.repeat(batch.column(0).to_numpy(), spec.posted)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(ids)], names=["key", "id"])

    tokens = sigs.select("id", "sig").mapInArrow(post, "key long, id long")
    shared = tokens.join(tokens.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "key")
    own = Window.partitionBy("id")
    ranked = shared.select("key", "id", F.row_number().over(own.orderBy("n", "key")).alias("rank"), F.count("*").over(own).alias("m"))
    # values that no other class has come first in the order of rarity; they are counted but not posted
    alone = F.lit(spec.posted) - F.col("m")
    return ranked.filter(F.col("rank") + alone <= spec.posted - spec.least_shared + 1).select("key", "id")


def _matching(pairs: DataFrame, sigs: DataFrame, spec: NearSpec) -> DataFrame:
    """Pairs whose signatures agree in at least ``match_threshold`` coordinates, with that number."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                hits = (_matrix(batch.column(2), spec.coordinates) == _matrix(batch.column(3), spec.coordinates)).sum(1)
                keep = pa.array(hits >= spec.match_threshold)
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep), pa.array(hits).filter(keep)], names=["a", "b", "hits"])

    with_b = pairs.join(sigs.select(F.col("id").alias("b"), F.col("sig").alias("sig_b")), "b")
    both = with_b.join(sigs.select(F.col("id").alias("a"), F.col("sig").alias("sig_a")), "a")
    return both.select("a", "b", "sig_a", "sig_b").mapInArrow(count, "a long, b long, hits long")


def _narrowed(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The ``rows`` whose id is in ``wanted``, and some others: those whose hash is marked in bitmaps of 4 MB at most.

    Every task gets the bitmaps, so texts that are no candidates stay where they are, however many ids are wanted.
    """
    spot = F.pmod(F.xxhash64("id"), F.lit(BLOCK * BLOCKS))
    block, bit = F.shiftright(spot, 15), F.pmod(spot, F.lit(BLOCK))
    marks = wanted.select(block.alias("_block"), bit.alias("bit")).groupBy("_block").agg(F.bitmap_construct_agg("bit").alias("_marks"))
    byte = F.conv(F.hex(F.substring("_marks", F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.getbit(byte, F.pmod(bit, F.lit(8)).cast("int")) == 1
    return rows.join(F.broadcast(marks), (block == F.col("_block")) & marked).select(*rows.columns)


class _Confirmer:
    """Confirms pairs on whole sets, made anew from the texts of a pair: a text takes less room than its set.

    The texts that were candidates before are kept in written tables.
    """

    def __init__(self, texts: DataFrame, spec: NearSpec):
        self.texts, self.spec, self.kept = texts, spec, None

    def _with_texts(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` with text_a and text_b."""
        wanted = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
        if self.kept is not None:
            wanted = settle_narrow(wanted.join(self.kept.select("id"), "id", "left_anti"), "wanted")
        if self.kept is None or not wanted.isEmpty():
            # an inner join (ids are wanted once): Spark would put a semi join before the filter, and shuffle all texts
            more = settle(_narrowed(self.texts, wanted).join(wanted, "id").select("id", "text"), "texts")
            self.kept = more if self.kept is None else self.kept.unionByName(more)
        with_b = pairs.join(self.kept.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
        return with_b.join(self.kept.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")

    def __call__(self, pairs: DataFrame) -> DataFrame:
        """The linked pairs ``(a, b)`` among ``pairs``."""
        percent, width = self.spec.percent, self.spec.words

        def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = []
                for p, q in zip(_each_set(batch.column(2), width), _each_set(batch.column(3), width), strict=True):
                    both = len(np.intersect1d(p, q, assume_unique=True))
                    keep.append(100 * both >= percent * (len(p) + len(q) - both))
                mask = pa.array(keep, pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

        return self._with_texts(pairs.select("a", "b")).select("a", "b", "text_a", "text_b").mapInArrow(linked, "a long, b long").distinct()

    def differences(self, members: DataFrame) -> DataFrame:
        """For rows ``(a, b, part, core)`` of a centre a and a member b: b's size n, and the ``delta`` items of ``s`` that one of both has alone."""

        width = self.spec.words

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sizes, deltas = [], []
                for p, q in zip(_each_set(batch.column(4), width), _each_set(batch.column(5), width), strict=True):
                    delta = np.setxor1d(p, q, assume_unique=True)
                    sizes.append((len(q), len(delta)))
                    deltas.append(delta.tobytes())
                columns = [*batch.columns[:4], pa.array([x for x, _ in sizes], pa.int64()), pa.array([y for _, y in sizes], pa.int64()), pa.array(deltas, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "part", "core", "n", "s", "delta"])

        schema = "a long, b long, part long, core long, n long, s long, delta binary"
        return self._with_texts(members).select("a", "b", "part", "core", "text_a", "text_b").mapInArrow(compare, schema)


def _labelled(posts: DataFrame, parts: DataFrame | None) -> DataFrame:
    """Postings with the component each class is in so far."""
    if parts is None:
        return posts.withColumn("part", F.col("id"))
    return posts.join(parts.select(F.col("node").alias("id"), F.col("component").alias("part")), "id", "left").withColumn("part", F.coalesce("part", "id"))


def _star(posts: DataFrame, seed: int) -> DataFrame:
    """Each member of a list next to a head of it that is in another component; heads differ from list to list."""
    rank = F.struct(F.xxhash64("part", "key", F.lit(seed)).alias("x"), F.col("id"), F.col("part"))
    heads = posts.groupBy("key").agg(F.min(rank).alias("head"), F.min("part").alias("p"), F.max("part").alias("q")).filter("p != q")
    met = posts.join(heads.select("key", "head"), "key").filter("part != head.part")
    return met.select(F.col("head.id").alias("a"), F.col("id").alias("b")).distinct()


def _open_members(posts: DataFrame, links: DataFrame | None) -> DataFrame:
    """``(a, b, part, core)``: members b of open lists with the list's centre a; part and core are their components."""
    if links is None:
        posts = posts.withColumn("degree", F.lit(0).cast("long"))
    else:
        ends = links.select(F.col("a").alias("id")).unionByName(links.select(F.col("b").alias("id")))
        posts = posts.join(ends.groupBy("id").agg(F.count("*").alias("degree")), "id", "left").fillna(0, ["degree"])
    rank = F.struct("degree", (-F.col("id")).alias("first"), "id", "part")
    lists = posts.groupBy("key").agg(F.min("part").alias("p"), F.max("part").alias("q"), F.max(rank).alias("c")).filter("p != q")
    rows = posts.select("key", "id", "part").join(lists.select("key", "c"), "key")
    return rows.select(F.col("c.id").alias("a"), F.col("id").alias("b"), "part", F.col("c.part").alias("core")).distinct()


def _delta_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each item in which a member and its centre differ."""
    for batch in batches:
        deltas = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(0)]
        if deltas:
            at = pa.array(np.repeat(np.arange(len(deltas)), [len(x) for x in deltas]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(deltas)), *(c.take(at) for c in batch.columns[1:])], names=["item", *batch.schema.names[1:]])


def _with_hub(differences: DataFrame, percent: int) -> DataFrame:
    """``differences`` with their ``excess``, the list's hub, whether a member is linked with it by excess alone, and the least excess of those that are not.

    Sets differ in s + s' - 2 o items if o is what their deltas share, so they are linked if and only if their excesses,
    (100 + percent) s - (100 - percent) n, add up to at most 2 (100 + percent) o. With a sum of at most zero
    they are linked whatever they share, and then both are linked with the hub, the member of least excess.
    ``outer`` is null where all members are in the centre's component or linked with the hub.
    """
    rows = differences.withColumn("excess", F.lit(100 + percent) * F.col("s") - F.lit(100 - percent) * F.col("n"))
    small = rows.select("a", "b", "part", "core", "excess")
    near = F.col("excess") + F.col("hub.excess") <= 0
    hubs = small.join(small.groupBy("a").agg(F.min(F.struct("excess", "b")).alias("hub")), "a")
    hubs = hubs.groupBy("a").agg(F.min("hub").alias("hub"), F.min(F.when(~near & (F.col("part") != F.col("core")), F.col("excess"))).alias("outer"))
    return rows.join(hubs, "a").withColumn("near", near)


def _met(hubbed: DataFrame, percent: int) -> DataFrame:
    """Rows ``(a, x_b, b)``, one for each item in which two members of one centre and of different components meet.

    A pair is met from its member of larger excess, which is not linked with the hub. What it has to share grows with both excesses, so
    members far from the centre post only their own rarest differences, and none is paired for its size. ``left`` counts a member's items from
    this one on, in the order of rarity: a linked pair has all that it shares left where it first meets, and rows with fewer are not made.
    """
    rows = hubbed.filter("outer is not null").withColumn("part", F.when(F.col("near"), F.col("core")).otherwise(F.col("part")))
    unit = 2 * (100 + percent)
    share = lambda x: F.greatest(F.lit(1), F.ceil((F.col("excess") + x) / F.lit(unit)))
    rows = rows.withColumns({"posted": share(F.greatest("outer", "excess")), "sought": share(F.col("hub.excess"))}).filter("s >= posted or part != core")
    items = rows.select("delta", "a", "b").mapInArrow(_delta_rows, "item long, a long, b long")
    shared = items.join(items.groupBy("a", "item").agg(F.count("*").alias("f")).filter("f > 1"), ["a", "item"])
    own = Window.partitionBy("a", "b")
    # items that no other member has come first in the order of rarity
    place = F.count("*").over(own) - F.row_number().over(own.orderBy("f", "item")) + 1
    ranked = shared.join(rows.select("a", "b", "part", "core", "excess", "posted", "sought"), ["a", "b"]).withColumn("left", place)
    ranked = settle(ranked.filter("left >= posted or (part != core and left >= sought)"), "ranked")
    sought = ranked.filter("part != core and left >= sought").select(*(F.col(c).alias(f"x_{c}") for c in ("a", "item", "b", "part", "excess", "sought", "left")))
    posted = ranked.filter("left >= posted").select("a", "item", "b", "part", "excess", "posted", "left")
    earlier = F.struct("excess", "b") < F.struct("x_excess", "x_b")
    enough = F.col("excess") + F.col("x_excess") <= F.lit(unit) * F.least("left", "x_left")
    met = sought.join(posted, (F.col("x_a") == F.col("a")) & (F.col("x_item") == F.col("item")) & (F.col("x_part") != F.col("part")) & earlier & enough)
    return met.select("a", "x_b", "b")


def _open_pairs(hubbed: DataFrame, percent: int) -> DataFrame:
    """Pairs of members of one centre, in different components, whose deltas can share enough: they have met with so many items left."""
    return _met(hubbed, percent).select(F.least("x_b", "b").alias("a"), F.greatest("x_b", "b").alias("b")).distinct()


def _confirmed(pairs: DataFrame, parts: DataFrame | None, confirm: _Confirmer, tries: int) -> DataFrame | None:
    """Links among ``pairs`` that connect all components which the linked ones of them connect.

    One link between two components is enough: ``tries`` pairs of each two are confirmed first, the others only where these are not linked.
    """
    if parts is not None:
        for c in ("a", "b"):
            pairs = pairs.join(parts.select(F.col("node").alias(c), F.col("component").alias(f"part_{c}")), c, "left")
    part_a, part_b = (F.lit(None) if parts is None else F.col(f"part_{c}") for c in ("a", "b"))
    part_a, part_b = F.coalesce(part_a, F.col("a")), F.coalesce(part_b, F.col("b"))
    pairs = settle_narrow(pairs.select("a", "b", F.least(part_a, part_b).alias("p"), F.greatest(part_a, part_b).alias("q")), "open")
    if pairs.isEmpty():
        return None
    place = F.row_number().over(Window.partitionBy("p", "q").orderBy(F.xxhash64("a", "b"), "a", "b"))
    first = settle_narrow(pairs.withColumn("place", place).filter(F.col("place") <= tries).drop("place"), "first")
    found = settle_narrow(confirm(first), "found")
    linked = first.join(found, ["a", "b"]).select("p", "q").distinct()
    rest = settle_narrow(pairs.join(linked, ["p", "q"], "left_anti").join(first, ["a", "b"], "left_anti").select("a", "b"), "rest")
    return found if rest.isEmpty() else found.unionByName(confirm(rest))


def near_duplicates(docs: DataFrame, spec: NearSpec | None = None, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id_column, n_shingles, component_id, kept)`` for every row of ``docs``.

    Texts without words (null, empty, white space) have no shingles and are linked with nothing. Repeated rows
    get the same answer, and rows that share an id count as one document for linking. A null id takes part
    under a stand-in above all real ids (which stay below 2**62); its component is null unless a document
    with an id is in it, and it is kept only in the first case. Other columns are not read.
    """
    rows = _verdicts(docs, spec or NearSpec(), id_column, text)
    real = F.lit(1 << 62)
    return rows.select(
        F.when(F.col("id") < real, F.col("id")).alias(id_column),
        "n_shingles",
        F.when(F.col("component") < real, F.col("component")).alias("component_id"),
        (F.col("id") == F.col("component")).alias("kept"),
    )


def _key(id_column: str, text: str) -> Column:
    """The id as a number; a null one has a stand-in by its text."""
    stand_in = F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(text), F.lit(""))), 2).bitwiseOR(F.lit(1 << 62))
    return F.coalesce(F.col(id_column).cast("long"), stand_in)


def _verdicts(docs: DataFrame, spec: NearSpec, id_column: str, text: str) -> DataFrame:
    """``(id, hash, n_shingles, h1, h2, component)`` for every row: the key, a hash of its text and of its set."""
    with records_per_batch(docs.sparkSession, 512):  # a row holds a text, or the whole sets of a pair
        return _classified(docs, spec, id_column, text)


def _classified(docs: DataFrame, spec: NearSpec, id_column: str, text: str) -> DataFrame:
    texts = docs.select(_key(id_column, text).alias("id"), F.col(text).alias("text"))
    hashed = texts.select("id", "text", F.xxhash64("text").alias("hash"))
    sketch = settle(hashed.mapInArrow(lambda x: _sketches(x, spec), "id long, hash long, n_shingles long, h1 long, h2 long, sig binary"), "sketches")
    filled = sketch.filter("n_shingles > 0")
    classes = settle(filled.groupBy("h1", "h2").agg(F.min("id").alias("id"), F.min("sig").alias("sig")), "classes")
    sigs = classes.select("id", "sig")
    confirm = _Confirmer(texts, spec)

    posts = settle(_postings(sigs, spec), "posts")
    links, parts = None, None
    for seed in range(spec.star_rounds):
        matched = _matching(_star(_labelled(posts, parts), seed), sigs, spec)
        nearest = Window.partitionBy("b").orderBy(F.desc("hits"), "a")  # at most one head for each posted coordinate
        best = matched.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= spec.heads)
        found = confirm(settle_narrow(best.select("a", "b"), "pairs"))
        links = settle_narrow(found if links is None else found.unionByName(links), "links")
        parts = connected_components(links)
    members = _open_members(_labelled(posts, parts), links)
    hubbed = settle(_with_hub(settle(confirm.differences(members), "differences"), spec.percent), "hubbed")
    to_hub = hubbed.filter("near and b != hub.b").select(F.col("hub.b").alias("a"), "b").distinct()
    more = _confirmed(_open_pairs(hubbed, spec.percent), parts, confirm, spec.tries)
    found = to_hub if more is None else to_hub.unionByName(more)
    parts = connected_components(found if links is None else links.unionByName(found))

    of_class = classes.select("h1", "h2", "id").join(parts.select(F.col("node").alias("id"), "component"), "id", "left")
    of_class = of_class.select("h1", "h2", F.coalesce("component", "id").alias("component")).groupBy("h1", "h2").agg(F.min("component").alias("component"))
    rows = sketch.join(of_class, ["h1", "h2"], "left").withColumn("component", F.coalesce("component", "id"))
    return rows.select("id", "hash", "n_shingles", "h1", "h2", "component")


def drop_near_duplicates(docs: DataFrame, spec: NearSpec | None = None, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` for each kept document: the one with the smallest id of its component.

    Rows are told apart by id and text. Rows equal in both are one document, and so are rows of one id with the same
    shingles, and null ids with the same text. Only texts that occur again under their id are shuffled for it.
    """
    rows = settle(_verdicts(docs, spec or NearSpec(), id_column, text), "verdicts")
    pairs = rows.groupBy("id", "hash").agg(F.count("*").alias("n"), *(F.min(c).alias(c) for c in ("n_shingles", "h1", "h2", "component")))
    by_set = ["id", "h1", "h2", F.when(F.col("n_shingles") == 0, F.col("hash"))]
    pairs = pairs.withColumn("first", F.min("hash").over(Window.partitionBy(*by_set)))
    pairs = settle(pairs.select("id", "hash", "n", ((F.col("id") == F.col("component")) & (F.col("hash") == F.col("first"))).alias("kept")), "kept")
    own = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    marked = docs.select(*(F.col(c).alias(a) for c, a in own.items()), _key(id_column, text).alias("_key"), F.xxhash64(text).alias("_hash"))
    found = lambda which: pairs.filter(which).select(F.col("id").alias("_key"), F.col("hash").alias("_hash"))
    single = marked.join(found("not kept or n > 1"), ["_key", "_hash"], "left_anti")
    again = marked.join(found("kept and n > 1"), ["_key", "_hash"], "left_semi").dropDuplicates(["_key", "_hash"])
    return single.unionByName(again).select(*(F.col(a).alias(c) for c, a in own.items()))
