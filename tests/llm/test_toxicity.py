import random
import zlib

from hourloom.llm.toxicity import ToxicSpec, _Analyst, held_out, score_toxicity
from hourloom.llm.textbytes import text_slices
import pyarrow as pa

SPEC = ToxicSpec(trees=6, depth=2)


def corpus(n=700):
    rng = random.Random(13)
    plain = [f"{a}{b}" for a in ("an", "the", "or", "win", "sel", "mor") for b in ("der", "ing", "ta", "lo", "ble", "st", "y")]
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(plain, k=rng.randrange(10, 200))
        toxic = rng.random() < 0.2
        if toxic:
            bad = "idiot moron trash".split() if i % 2 else [f"grumf{x}" for x in ("a", "el", "ous", "ty")]
            for _ in range(rng.randrange(2, 8)):
                words.insert(rng.randrange(len(words)), rng.choice(bad) + rng.choice(["", ",", "!"]))
        rows.append((i, " ".join(words)))
        if i % 10:
            labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_rows_are_told_apart(spark):
    rows, labels = corpus()
    extra = [(None, "nobody"), (5000, None), (5001, ""), (5001, ""), (5002, "word " * 40_000)]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows + extra], "doc_id long, text string, score double").repartition(4)
    table = spark.createDataFrame([*labels, (None, 1), (3, None), labels[0]], "doc_id long, toxic int")
    got = score_toxicity(docs, table, SPEC).collect()
    assert len(got) == len(rows) + len(extra) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    by_id = {r.doc_id: r for r in got}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got if r.doc_id is not None)
    assert not by_id[None].held_out and by_id[5000].score == by_id[5001].score
    told = [(by_id[i].predicted, y) for i, y in labels if by_id[i].held_out]
    assert sum(p == y for p, y in told) >= 0.95 * len(told) and len(told) > 100
    assert [by_id[i].predicted for i in (5000, 5001, 5002)] == [0, 0, 0]
    # held-out labels change nothing
    flipped = spark.createDataFrame([(i, 1 - y if by_id[i].held_out else y) for i, y in labels], "doc_id long, toxic int")
    again = {r.doc_id: r.score for r in score_toxicity(docs, flipped, SPEC).collect()}
    assert all(abs(again[i] - by_id[i].score) < 1e-9 for i, _ in rows)


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in score_toxicity(docs, none).collect()} == {0.0}
    one_class = spark.createDataFrame([(1, 0), (2, 0)], none.schema)
    assert {r.predicted for r in score_toxicity(docs, one_class).collect()} == {0}
    assert score_toxicity(docs.limit(0), none).count() == 0
    assert docs.select(held_out("doc_id").alias("h")).dtypes == [("h", "boolean")]


def test_flags():
    analyst = _Analyst(frozenset({"grumf"}), frozenset({"blar*"}), ToxicSpec())
    flags = {t: analyst.flags_of(t) for t in ("idiot,", "GRUMF!!", "blarney", "blar", "you", "1d10t", "id.i.o.t", "plain", "It's", "A")}
    assert flags["idiot,"] == 1 and flags["GRUMF!!"] == 2 | 16 and flags["blarney"] == 4 and flags["blar"] == 0 and flags["you"] == 8
    assert flags["plain"] == flags["It's"] == flags["A"] == 0 and flags["id.i.o.t"] & 96 == 96
    features = analyst.features(next(text_slices(pa.array(["you idiot WOW!", None]))))
    assert features[0, 1] == 1 / 3 and features[0, 8] == 1 / 3 and features[0, 9] == 1 / 3 and not features[1].any()
