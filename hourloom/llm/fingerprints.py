"""Document fingerprints: threshold-scaled sketches of word shingles, in DataFrame functions alone.

A sketch keeps every shingle hash below ``2**bits * fraction``, whatever the length of the text, so sketches of parts
merge by union and a short text is found inside a long one: the share of its kept hashes that the other has
estimates containment. The fraction is one unless a caller asks for less: containment is then exact at any length.
With a smaller one a short text may keep no hash at all, and what it is contained in stays unknown.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourloom.sources.workspace import settle

WHITE = r"[\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class SketchSpec:
    """One in ``one_in`` shingles of ``words`` words is kept, as a hash of ``digits`` hexadecimal digits."""

    words: int = 5
    one_in: int = 1
    digits: int = 10


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def shingle_hashes(text: Column, spec: SketchSpec) -> Column:
    """The hash of every run of ``words`` words; a text with fewer words has its whole sequence as the only one."""
    shift = 64 - 4 * spec.digits

    def hashed(words: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(words) - (spec.words - 1)))
        hashes = F.transform(starts, lambda i: F.shiftrightunsigned(F.xxhash64(F.slice(words, i, spec.words)), shift))
        return F.when(F.size(words) > 0, hashes).otherwise(F.array().cast("array<bigint>"))

    return _let(F.filter(F.split(F.translate(text, _UPPER, _LOWER), WHITE), lambda w: w != ""), hashed)


def sketch(hashes: Column, spec: SketchSpec) -> Column:
    """Ascending distinct kept hashes of an array column, none if all are above the bound; null stays null."""
    bound = (1 << (4 * spec.digits)) // spec.one_in
    kept = hashes if spec.one_in == 1 else F.filter(hashes, lambda h: h < bound)
    return F.sort_array(F.array_distinct(kept))


def printed(sketched: Column, spec: SketchSpec) -> Column:
    """A sketch as text: its hashes, ``digits`` hexadecimal digits each, one after the other."""
    return F.array_join(F.transform(sketched, lambda h: F.lower(F.lpad(F.hex(h), spec.digits, "0"))), "")


def merged(a: Column, b: Column) -> Column:
    """The sketch of two texts' shingles together."""
    return F.array_sort(F.array_union(a, b))


def containment(a: Column, b: Column, spec: SketchSpec | None = None) -> Column:
    """Share of the smaller sketch's shingles that the other has, an estimate if only some are kept.

    Of sketches that keep all, two empty ones are alike and one is not; of others an empty one says nothing: null.
    """
    least = F.least(F.size(a), F.size(b))
    share = F.when(least > 0, F.size(F.array_intersect(a, b)) / least)
    if (spec or SketchSpec()).one_in == 1:
        share = share.when(F.size(a) == F.size(b), 1.0).otherwise(0.0)
    return share.cast("double")


def in_order(rows: DataFrame, *columns: str) -> DataFrame:
    """``rows`` with ``_at``, a number that grows by one from row to row of a partition of the global order.

    Written once, so that every reader sees the same numbers.
    """
    return settle(rows.orderBy(*columns).withColumn("_at", F.monotonically_increasing_id()), "ordered")


def ring(keys: DataFrame, columns: list[str]) -> DataFrame:
    """Each key next to the one that follows it (``next_...``), the first after the last; ``keys`` are distinct.

    Neighbours in a partition meet by an equal-number join; the ends of partitions, one row each, by a window
    over as many rows as the sort has partitions.
    """
    rows = in_order(keys, *columns)
    part = F.shiftright("_at", 33)
    ends = rows.groupBy(part.alias("p")).agg(F.min("_at").alias("first"), F.max("_at").alias("last"))
    after = F.lead("first").over(Window.orderBy("p"))
    first = F.first("first").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    jumps = ends.select(F.col("last").alias("_at"), F.coalesce(after, first).alias("_jump"))
    linked = rows.join(jumps, "_at", "left").withColumn("_next", F.coalesce("_jump", F.col("_at") + 1))
    following = rows.select(F.col("_at").alias("_next"), *(F.col(c).alias(f"next_{c}") for c in columns))
    return linked.join(following, "_next").select(*columns, *(f"next_{c}" for c in columns))


def compare_with_edits(docs: DataFrame, spec: SketchSpec | None = None, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id_column, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, next id)`` for every row of ``docs``.

    The edited text has its last quarter of code points replaced by the first as many (or all) of the next document
    by id, after the last the first; a single document follows itself. Null texts count as empty, null ids come
    first. Rows that share an id are told apart by a hash of their text and follow each other by it; equal rows are
    one document and all get its answer. Other columns are not read.
    """
    spec = spec or SketchSpec()
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id_column).alias("id"), body.alias("text"), F.length(body).alias("n"), F.xxhash64(body).alias("h"), F.xxhash64(F.col(id_column), body).alias("k"))
    keys = rows.select("id", "h", "k", "n").distinct()
    order = settle(ring(keys, ["id", "h", "k", "n"]).select("k", F.col("next_k").alias("next"), F.floor(F.col("n") / 4).cast("int").alias("need")), "ring")
    # each document's text goes to the one before it, as it is shorter than its hashes; both joins use the same
    # columns of the texts, so these are shuffled once by their own key and once by that of the one before
    own = rows.select("id", "text", "k")
    given = own.join(order.select(F.col("next").alias("k"), F.col("k").alias("to"), "need"), "k")
    given = given.select(F.col("to").alias("k"), "need", F.col("text").alias("next_text"), F.col("id").alias("next_id")).dropDuplicates(["k"])
    n = F.length("text")
    both = own.join(given, "k").withColumn("edited", F.concat(F.substring("text", F.lit(1), n - F.col("need")), F.substring("next_text", F.lit(1), F.col("need"))))
    made = {to: sketch(shingle_hashes(F.col(c), spec), spec) for to, c in (("print", "text"), ("edited_print", "edited"), ("next_print", "next_text"))}
    both = both.withColumns(made)
    return both.select(
        F.col("id").alias(id_column),
        n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        printed(F.col("print"), spec).alias("fingerprint"),
        printed(F.col("edited_print"), spec).alias("edited_fingerprint"),
        containment(F.col("print"), F.col("edited_print"), spec).alias("near_edited"),
        containment(F.col("print"), F.col("next_print"), spec).alias("near_next"),
        F.col("next_id").alias(f"next_{id_column}"),
    )
