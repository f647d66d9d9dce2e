"""Toxicity scores: gradient-boosted trees over dense text features, calibrated by isotonic regression.

Features are densities: words of a fixed insult list, words and stems learned from labelled rows, second person near
them, capitals, punctuation, obfuscated spellings. Tokens are analysed once each while a worker remembers them, so a
text costs one look-up per token. Trees and calibration are fitted on a bounded sample of labelled rows, drawn by
hash; scores are for every row and use the text alone.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourloom.llm.near_dup import shingle_sets, signatures
from hourloom.llm.textbytes import TextSlice, per_document, text_slices
from hourloom.sources.workspace import settle

# Common insults in the four languages of the corpus.
INSULTS = frozenset(
    """asshole bastard bitch clown coward crap creep degenerate despicable dimwit disgusting dumb dumbass dunce filth fool
    freak garbage hateful idiot idiotic ignorant imbecile jerk liar loser lunatic moron moronic nasty parasite pathetic
    pig prick psycho rat repulsive retard scum scumbag shit slime stupid trash twit ugly useless vermin vile weirdo
    whore worthless wretch arschloch blödmann depp dreckskerl dumm dummkopf hässlich idiotisch lächerlich miststück
    nutzlos schwachkopf schwein trottel versager wertlos abruti connard crétin débile dégoûtant imbécile merde minable
    ordure pathétique pourri raté salaud stupide basura cabrón estúpido gilipollas idiota imbécil inútil mierda patético
    asqueroso tonto""".split()
)
SECOND_PERSON = frozenset("you your yours yourself yourselves u ur du dich dir dein deine deinen deiner euch ihr tu te toi ton ta tes vous votre vos ti tú tus usted ustedes vosotros vuestro".split())
_LEET = str.maketrans("013457@$!|", "oieastasil")
_LETTERS = re.compile(r"[^\W\d_]+")
_INNER = re.compile(r"[^\W\d_][^\w\s]*[\d@$!|*._-]+[^\s]*[^\W\d_]")
_PUNCT = np.zeros(256, bool)
_PUNCT[list(b"!?")] = True
_MARKS = np.zeros(256, bool)
_MARKS[list(b"#$%&*+=@^_|~<>\\/")] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[0x41:0x5B] = True

FEATURES = (
    "log_words", "insults", "log_insults", "sure_terms", "log_sure_terms", "likely_terms", "log_likely_terms", "second_person",
    "insults_near_you", "shouted_words", "capitals", "exclamations", "marks", "disguised_insults", "obfuscated",
)


@dataclass(frozen=True)
class ToxicSpec:
    """``max_fit_rows`` bounds the labelled rows that lexicon, trees and calibration see; ``max_terms`` the learned lexicon.

    A term is likely if ``least_texts`` toxic texts and a share of ``least_precision`` of all texts with it are toxic; it is
    sure if the log-likelihood ratio against the base rate reaches ``sure``, which chance does once in 160,000 terms.
    """

    max_fit_rows: int = 20_000
    max_terms: int = 3_000
    calibration_share: float = 0.3
    stems: tuple[int, ...] = (4, 5, 6)
    least_texts: int = 3
    least_precision: float = 0.9
    sure: float = 12.0
    near_words: int = 5
    trees: int = 24
    depth: int = 3
    step: float = 0.3
    cached_tokens: int = 400_000
    seed: int = 9


def terms_of(word: str, spec: ToxicSpec) -> list[str]:
    """The word and its beginnings, as the lexicon lists them."""
    return [word, *(f"{word[:n]}*" for n in spec.stems if len(word) > n)]


class _Analyst:
    """Flags of tokens: 1 insult, 2 sure term, 4 likely term, 8 second person, 16 shouted, 32 disguised insult, 64 obfuscated.

    Terms are words, or word beginnings followed by a star.
    """

    def __init__(self, sure: frozenset[str], likely: frozenset[str], spec: ToxicSpec):
        self.sure, self.likely, self.spec, self.known = sure, likely, spec, {}

    def flags_of(self, token: str) -> int:
        low = token.lower()
        parts = _LETTERS.findall(low)
        out = 0
        for part in parts:
            terms = terms_of(part, self.spec)
            out |= (part in INSULTS) | 2 * (not self.sure.isdisjoint(terms)) | 4 * (not self.likely.isdisjoint(terms)) | 8 * (part in SECOND_PERSON)
        out |= 16 * (sum(map(len, parts)) > 1 and token == token.upper() != low)
        if _INNER.search(low):
            plain = "".join(_LETTERS.findall(low.translate(_LEET)))
            joined = "".join(parts)
            out |= 64 | 32 * (plain in INSULTS or plain in self.sure or joined in INSULTS or joined in self.sure)
        return out

    def flags(self, tokens: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > self.spec.cached_tokens:
            known.clear()
        for token in (t for t in set(tokens) if t not in known):
            known[token] = self.flags_of(token)
        return np.fromiter(map(known.__getitem__, tokens), np.uint8, len(tokens))

    def features(self, s: TextSlice) -> np.ndarray:
        n = np.maximum(1, np.diff(s.edges))
        out = np.zeros((len(s), len(FEATURES)))
        for i in range(len(s)):
            flags = self.flags(s.text(i).decode("utf-8", "replace").split())
            words = max(1, len(flags))
            hits, you = np.flatnonzero(flags & 39), np.flatnonzero(flags & 8)
            near = 0
            if len(hits) and len(you):
                at = np.searchsorted(you, hits)
                gap = np.minimum(np.abs(hits - you[np.minimum(at, len(you) - 1)]), np.abs(hits - you[np.maximum(at - 1, 0)]))
                near = int((gap <= self.spec.near_words).sum())
            count = [int(np.count_nonzero(flags & bit)) for bit in (1, 2, 4, 8, 16, 32, 64)]
            out[i, :11] = [math.log1p(len(flags)), count[0] / words, math.log1p(count[0]), count[1] / words, math.log1p(count[1]), count[2] / words, math.log1p(count[2]), count[3] / words, near / words, count[4] / words, 0.0]
            out[i, 13:] = count[5] / words, count[6] / words
        for column, flagged in ((10, _CAPITAL), (11, _PUNCT), (12, _MARKS)):
            out[:, column] = per_document(flagged[s.data], s.edges) / n
        return out


def held_out(id_column: str) -> Column:
    """Whether crc32 of the id as text is 1 modulo 3; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds one MinHash coordinate: copies and most near copies of a text share it."""
    for batch in batches:
        for s in text_slices(batch.column(1)):
            sets, edges = shingle_sets(s, 5)
            group = signatures(sets, edges, 1)[:, 0].astype(np.int64)
            rows = batch.slice(s.first, len(s))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(group)], names=["id", "text", "toxic", "grp"])


def training_rows(docs: DataFrame, labels: DataFrame, spec: ToxicSpec, id_column: str, text: str, label: str) -> DataFrame:
    """At most ``max_fit_rows`` labelled rows outside the held-out fold: id, text, toxic, grp and their role (left, right, calibrate).

    Rows without a label or an id are left out; of repeated labels the largest counts; of texts that share a group
    and a label one stays, so that copies do not outvote the rest.
    """
    order = F.xxhash64(F.lit(spec.seed), F.col("id"))
    chosen = labels.select(F.col(id_column).alias("id"), F.col(label).cast("int").alias("toxic")).dropna().filter(~held_out("id"))
    chosen = chosen.groupBy("id").agg(F.max("toxic").alias("toxic")).orderBy(order).limit(spec.max_fit_rows)
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(chosen), "id").select("id", "text", "toxic")  # max_fit_rows rows of 12 bytes
    rows = settle(rows.mapInArrow(_groups, "id long, text string, toxic int, grp long"), "labelled")
    one = Window.partitionBy("grp", "toxic").orderBy("id")
    rows = rows.withColumn("copy", F.row_number().over(one)).filter("copy = 1").drop("copy")
    # a whole group has one role, so no text is fitted and calibrated on in two copies
    draw = F.pmod(F.xxhash64("grp"), F.lit(1000))
    share = int(1000 * spec.calibration_share)
    role = F.when(draw < share, "calibrate").when(F.pmod(draw, F.lit(2)) == 0, "left").otherwise("right")
    return settle(rows.withColumn("role", role), "training")


def learned_lexicon(rows: DataFrame, spec: ToxicSpec) -> tuple[frozenset[str], frozenset[str]]:
    """Sure and likely terms: words and word beginnings of toxic texts that hardly stand in others; at most ``max_terms``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list[int]] = {}
        for batch in batches:
            for t, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = set(_LETTERS.findall(t.lower()))
                for term in {t for w in words for t in terms_of(w, spec)}:
                    found.setdefault(term, [0, 0])[1 if toxic else 0] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array([x[1] for x in found.values()], pa.int64()), pa.array([x[0] for x in found.values()], pa.int64())], names=["term", "toxic", "clean"])

    total = rows.agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).first()
    least = max(spec.least_texts, math.ceil(0.002 * (total.t or 0)))
    counts = rows.select("text", "toxic").mapInArrow(count, "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    best = counts.filter((F.col("toxic") >= least) & (F.col("toxic") >= spec.least_precision * (F.col("toxic") + F.col("clean"))))
    terms = best.orderBy(F.desc("toxic"), "clean", "term").limit(spec.max_terms).collect()
    rate = min(max((total.t or 0) / max(1, total.n), 1e-6), 1 - 1e-6)

    def weight(toxic: int, clean: int) -> float:
        n = toxic + clean
        return toxic * math.log(toxic / (n * rate)) + (clean * math.log(clean / (n * (1 - rate))) if clean else 0.0)

    sure = frozenset(r.term for r in terms if weight(r.toxic, r.clean) >= spec.sure)
    return sure, frozenset(r.term for r in terms) - sure


def with_features(rows: DataFrame, keep: list[str], sure: frozenset[str], likely: frozenset[str], spec: ToxicSpec, text: str = "text") -> DataFrame:
    """Columns ``keep`` and ``features``, an array of doubles in the order of ``FEATURES``."""
    types = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        analyst = _Analyst(sure, likely, spec)
        for batch in batches:
            for s in text_slices(batch.column(0)):
                values = analyst.features(s)
                edges = pa.array(np.arange(len(s) + 1, dtype=np.int32) * len(FEATURES))
                yield pa.RecordBatch.from_arrays([*batch.slice(s.first, len(s)).columns[1:], pa.ListArray.from_arrays(edges, pa.array(values.ravel()))], names=[*(f"k{i}" for i in range(len(keep))), "features"])

    schema = ", ".join([*(f"k{i} {types[c]}" for i, c in enumerate(keep)), "features array<double>"])
    out = rows.select(F.col(text).alias("t"), *(F.col(c).alias(f"k{i}") for i, c in enumerate(keep))).mapInArrow(run, schema)
    return out.withColumnsRenamed({f"k{i}": c for i, c in enumerate(keep)})


class ToxicityModel:
    """A fitted scorer: lexicon, trees and calibration."""

    def __init__(self, docs: DataFrame, labels: DataFrame, spec: ToxicSpec | None = None, id_column: str = "doc_id", text: str = "text", label: str = "toxic"):
        self.spec = spec = spec or ToxicSpec()
        rows = training_rows(docs, labels, spec, id_column, text, label)
        left, right, fit = rows.filter("role = 'left'"), rows.filter("role = 'right'"), rows.filter("role != 'calibrate'")
        self.sure, self.likely = learned_lexicon(fit, spec)
        # trees learn what the lexicon is worth on texts that it was not learned from
        made = with_features(rows.filter("role = 'calibrate'"), ["toxic", "role"], self.sure, self.likely, spec)
        made = made.unionByName(with_features(left, ["toxic", "role"], *learned_lexicon(right, spec), spec))
        made = made.unionByName(with_features(right, ["toxic", "role"], *learned_lexicon(left, spec), spec))
        calibrates = (F.col("role") == "calibrate").alias("calibrates")
        made = settle(made.select(F.col("toxic").cast("double").alias("label"), calibrates, array_to_vector("features").alias("features")).coalesce(8), "features")
        count = {(r.calibrates, r.label): r["count"] for r in made.groupBy("calibrates", "label").count().collect()}
        n = sum(count.values())
        self.base_rate = sum(c for (_, y), c in count.items() if y == 1) / n if n else 0.0
        self.trees = self.steps = None
        if all(count.get((False, y)) for y in (0.0, 1.0)):
            trees = GBTClassifier(maxIter=spec.trees, maxDepth=spec.depth, stepSize=spec.step, maxBins=64, seed=spec.seed, minInstancesPerNode=2)
            self.trees = trees.fit(made.filter("not calibrates"))
            # too few rows of a class to calibrate apart: all rows calibrate
            apart = all(count.get((True, y), 0) >= 20 for y in (0.0, 1.0))
            margins = self._margins(made.filter("calibrates") if apart else made, ["label"])
            self.steps = IsotonicRegression(featuresCol="margin", labelCol="label", predictionCol="step").fit(margins)

    def _margins(self, rows: DataFrame, keep: list[str]) -> DataFrame:
        scored = self.trees.transform(rows)
        return scored.select(*keep, vector_to_array("rawPrediction")[1].alias("margin"))

    def score(self, docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
        """``(id_column, score)`` for every row of ``docs``; without labels of both classes the score is their base rate.

        Null and empty texts are scored like any other, by features that are all zero. The score is the
        calibrated probability, with a hundredth of the uncalibrated one so that ties keep an order.
        """
        if self.trees is None:
            return docs.select(id_column, F.lit(self.base_rate).alias("score"))
        made = with_features(docs.select(id_column, text), [id_column], self.sure, self.likely, self.spec, text)
        margins = self._margins(made.select(F.col(id_column).alias("id"), array_to_vector("features").alias("features")), ["id"])
        smooth = 1 / (1 + F.exp(-2 * F.col("margin")))
        score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 0.99 * F.col("step") + 0.01 * smooth))
        return self.steps.transform(margins).select(F.col("id").alias(id_column), score.alias("score"))


def score_toxicity(docs: DataFrame, labels: DataFrame, spec: ToxicSpec | None = None, threshold: float = 0.7, id_column: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """``(id_column, held_out, score, predicted)`` for every row of ``docs``, fitted on rows that are not held out."""
    scored = ToxicityModel(docs, labels, spec, id_column, text, label).score(docs, id_column, text)
    return scored.select(id_column, held_out(id_column).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
