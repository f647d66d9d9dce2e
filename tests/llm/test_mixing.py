import random
import re

import numpy as np
from hourloom.llm.mixing import MixSpec, capped_targets, mix, mix_report, sainte_lague

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_quotients(votes, seats, limits):
    """One seat at a time to the highest quotient."""
    given = [0] * len(votes)
    for _ in range(min(seats, sum(x for v, x in zip(votes, limits, strict=True) if v > 0))):
        i = max((i for i in range(len(votes)) if given[i] < limits[i] and votes[i] > 0), key=lambda i: (votes[i] / (2 * given[i] + 1), -i))
        given[i] += 1
    return given


def test_seats_equal_the_highest_quotients():
    rng = random.Random(2)
    for _ in range(300):
        n = rng.randrange(1, 9)
        votes = [rng.choice([0, rng.randrange(1, 50), rng.randrange(1, 5000)]) for _ in range(n)]
        limits = [rng.randrange(0, 40) for _ in range(n)]
        seats = rng.randrange(0, 90)
        assert sainte_lague(np.array(votes), seats, np.array(limits)).tolist() == by_quotients(votes, seats, limits)
    assert sainte_lague(np.array([53000, 24000, 23000]), 7, np.array([99, 99, 99])).tolist() == [3, 2, 2]


def test_targets_stop_at_three_sizes():
    assert capped_targets([100, 100, 100], [5, 2, 1], 3) == [187.5, 75.0, 37.5]
    out = capped_targets([10, 1000, 90, 0], [5, 2, 1, 5], 3)
    assert out[0] == 30 and out[2] == 270 and abs(sum(out) - 1100) < 1e-6 and out[3] == 0
    assert capped_targets([], [], 3) == []


def corpus():
    rng = random.Random(9)
    rows = [(1, None, "a"), (2, "", "b"), (None, "x y z " * 30, "a"), (4, "last source " * 50, None), (5, "w " * 9000, "a")]
    rows += [(i, " ".join(f"{i}.{k}" for k in range(rng.randrange(0, 400))), "a" if i % 3 else rng.choice(["b", "Z", "é", None])) for i in range(10, 400)]
    return rows


def test_report_meets_targets_and_repeats(spark):
    rows = corpus()
    frame = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, size int")
    spec = MixSpec(shard_words=5000)
    got = mix_report(frame.repartition(7), spec).collect()
    assert sorted(map(str, got)) == sorted(map(str, mix_report(frame.repartition(3), spec).collect()))
    want = {i: len(WORD.findall(t or "")) for i, t, _ in rows}
    assert {r.doc_id: r["size"] for r in got} == want
    sizes, of = {}, {i: s for i, _, s in rows}
    for i, _, s in rows:
        sizes[s] = sizes.get(s, 0) + want[i]
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = dict(zip(order, capped_targets([sizes[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))], 3), strict=True))
    taken = dict.fromkeys(order, 0)
    for r in got:
        assert r.source_size == sizes[of[r.doc_id]] and abs(r.target - targets[of[r.doc_id]]) < 1e-6
        assert 0 <= r.taken <= 3 * r["size"]
        taken[of[r.doc_id]] += r.taken
    assert all(abs(taken[s] - targets[s]) <= 0.02 * targets[s] + 64 for s in order), (taken, targets)


def test_mixed_texts_have_the_taken_words(spark):
    rows = [r for r in corpus() if r[0] is not None]
    frame = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, source string, words string")
    spec = MixSpec(shard_words=5000)
    taken = {r.doc_id: r.taken for r in mix_report(frame, spec).collect()}
    out = mix(frame, spec)
    assert out.columns == frame.columns
    found, texts = {}, {i: t for i, t, _ in rows}
    for r in out.collect():
        words = WORD.findall(r.text)
        assert words and set(words) <= set(WORD.findall(texts[r.doc_id]))
        found[r.doc_id] = found.get(r.doc_id, 0) + len(words)
    assert found == {i: n for i, n in taken.items() if n}


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mix_report(frame).count() == 0
    assert mix(frame).count() == 0
    assert mix_report(spark.createDataFrame([(1, None, None)], frame.schema)).collect()[0].taken == 0


def test_columns_with_clashing_names(spark):
    rows = [(i, f"s{i % 3}", "word " * (i + 1), 1.5, "x", i, 2) for i in range(20)]
    plain = spark.createDataFrame([r[:3] for r in rows], "doc_id long, source string, text string")
    named = spark.createDataFrame(rows, "doc_id long, source string, text string, _size double, _source string, _place int, c0 int")
    got, want = (sorted(map(str, mix_report(x).collect())) for x in (named, plain))
    assert got == want
    assert {(r["_size"], r["_source"], r["c0"]) for r in mix(named).collect()} <= {(1.5, "x", 2)}
