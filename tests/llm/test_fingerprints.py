import hashlib
import random
import re

import pytest
from hourloom.llm.fingerprints import SketchSpec, compare_with_edits, containment, merged, shingle_hashes, sketch
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text):
    words = WORD.findall(text.translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    rows = sorted(rows)
    out = {}
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        need = len(t) // 4
        edited = t[: len(t) - need] + after[:need]
        out[i] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), edited, after)
    return out


def share(a, b):
    least = min(len(a), len(b))
    return len(a & b) / least if least else float(len(a) == len(b))


def corpus():
    rng = random.Random(11)
    texts = ["", " \n", "One two", "one TWO", "日本語 テキスト " * 40, "x" * 5000]
    texts += [" ".join(f"w{rng.randrange(500)}" for _ in range(rng.randrange(1, 900))) for _ in range(120)]
    texts += [texts[30]] * 3
    rng.shuffle(texts)
    return [(i * 7 - 50, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("one_in", [1, 8])
def test_equals_brute_force(spark, one_in):
    rows = corpus()
    frame = spark.createDataFrame([(*r, "q") for r in rows], "doc_id long, text string, n string").repartition(9)
    got = {r.doc_id: r for r in compare_with_edits(frame, SketchSpec(one_in=one_in)).collect()}
    want = brute(rows)
    assert got.keys() == want.keys()
    by_text, off = {}, []
    for i, t in rows:
        n, digest, edited, after = want[i]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (n, digest)
        assert by_text.setdefault(t, r.fingerprint) == r.fingerprint
        near = share(shingles(t), shingles(edited)), share(shingles(t), shingles(after))
        if one_in == 1:  # nothing is left out, so the estimate is exact
            assert (r.near_edited, r.near_next) == near
            assert len(r.fingerprint) == 10 * len(shingles(t))
        elif len(shingles(t)) > 200:
            off.append(abs(r.near_edited - near[0]))
    assert all(x < 0.35 for x in off) and sum(off) <= 0.08 * len(off)


def test_null_repeated_and_empty(spark):
    rows = [(None, "first by order"), (4, None), (4, None), (9, "a b c d e f"), (9, "another text")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = compare_with_edits(frame).collect()
    assert len(got) == 5
    assert {r.n_chars for r in got if r.doc_id == 4} == {0} and {r.near_edited for r in got if r.doc_id == 4} == {1.0}
    assert compare_with_edits(spark.createDataFrame([], frame.schema)).count() == 0
    one = compare_with_edits(spark.createDataFrame([(1, "abcdefgh")], frame.schema)).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and one.near_next == 1.0


def test_parts_merge_and_small_texts_are_contained(spark):
    rng = random.Random(1)
    words = [f"v{rng.randrange(10_000)}" for _ in range(6000)]
    a, b, small = " ".join(words[:3004]), " ".join(words[3000:]), " ".join(words[500:900])
    spec = SketchSpec()
    made = lambda c: sketch(shingle_hashes(F.col(c), spec), spec)
    row = spark.createDataFrame([(a, b, " ".join(words), small)], "a string, b string, c string, d string")
    got = row.select((merged(made("a"), made("b")) == made("c")).alias("same"), containment(made("d"), made("c")).alias("inside"), containment(made("d"), made("b")).alias("outside")).first()
    assert got.same and got.inside == 1.0 and got.outside == 0.0


def test_short_texts_have_exact_containment(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{rng.randrange(60)}" for _ in range(rng.randrange(1, 30)))) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    for r in compare_with_edits(frame).collect():
        _, _, edited, after = want[r.doc_id]
        own = shingles(rows[r.doc_id][1])
        assert (r.near_edited, r.near_next) == (share(own, shingles(edited)), share(own, shingles(after)))


@pytest.mark.parametrize("one_in", [1, 2, 8])
def test_short_parts_merge_to_the_sketch_of_the_whole(spark, one_in):
    spec = SketchSpec(one_in=one_in)
    rng = random.Random(6)
    rows = []
    for _ in range(200):
        words = [f"v{rng.randrange(10_000)}" for _ in range(24)]
        rows.append((" ".join(words[:9]), " ".join(words[5:]), " ".join(words)))
    made = lambda c: sketch(shingle_hashes(F.col(c), spec), spec)
    frame = spark.createDataFrame(rows, "a string, b string, c string")
    got = frame.select((merged(made("a"), made("b")) == made("c")).alias("same"), containment(made("a"), made("c"), spec).alias("inside")).collect()
    assert all(r.same for r in got) and {r.inside for r in got} - {None} == {1.0}
    assert one_in > 1 or all(r.inside == 1.0 for r in got)
