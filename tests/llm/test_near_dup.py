import random
import re
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from hourloom.llm import near_dup
from hourloom.llm.graph import connected_components
from hourloom.llm.near_dup import NearSpec, drop_near_duplicates, near_duplicates
from hourloom.sources import workspace

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text, width):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def brute(rows, width):
    """Component of each id, by comparing all pairs."""
    sets = [(i, shingles(t, width)) for i, t in rows]
    up = {i: i for i, _ in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            both = len(a & b)
            if both and 100 * both >= 80 * (len(a) + len(b) - both):
                x, y = sorted((root(i), root(j)))
                up[y] = x
    return {i: (len(s), root(i)) for i, s in sets}


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = [None, "", " \n", "solo", "Solo", "two words", "TWO words", "É x", "é x"]
    for n in (3, 4, 6, 30, 120):
        base = [rng.choice(vocabulary) for _ in range(n)]
        for _ in range(25):
            copy = list(base)
            for _ in range(rng.randrange(0, max(2, n // 12))):
                copy[rng.randrange(n)] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    passage = [rng.choice(vocabulary) for _ in range(40)]
    texts += [" ".join([*passage, *(rng.choice(vocabulary) for _ in range(rng.randrange(5, 60)))]) for _ in range(90)]
    chain = [rng.choice(vocabulary) for _ in range(100)]
    for k in range(40):  # each near its neighbour, the ends far apart
        chain = [*chain[3:], *(rng.choice(vocabulary) for _ in range(3))]
        texts.append(" ".join(chain))
    rng.shuffle(texts)
    return [*enumerate(texts), (1000, texts[5])]


@pytest.mark.parametrize("spec", [NearSpec(words=4), NearSpec(words=5, star_rounds=2, heads=1), NearSpec(words=4, star_rounds=0)])
def test_components_equal_brute_force(spark, spec):
    rows = corpus(spec.words + spec.star_rounds)
    want = brute(rows, spec.words)
    frame = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, component_id int").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(frame, spec).collect()}
    assert got == {i: (n, c, c == i) for i, (n, c) in want.items()}


def test_null_ids_repeated_rows_and_empty_tables(spark):
    text = " ".join(f"t{i}" for i in range(30))
    rows = [(None, text), (7, text), (7, text), (None, "alone here"), (9, None), (9, None)]
    got = sorted(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect(), key=str)
    assert [(r.doc_id, r.component_id, r.kept) for r in got if r.n_shingles == 26].count((7, 7, True)) == 2
    assert (None, 7, False) in [(r.doc_id, r.component_id, r.kept) for r in got]
    assert (None, None, True) in [(r.doc_id, r.component_id, r.kept) for r in got]
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_links(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(1000 + i, 1001 + i) for i in range(100)] + [(5, 5), (None, 3)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs[:-2]:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: root(x) for a, b in pairs[:-2] if a != b for x in (a, b)}


def test_one_row_of_each_class_stays(spark):
    words = lambda c: " ".join(f"{c}{i}" for i in range(30))
    rows = [(3, words("a")), (5, words("a")), (5, words("u")), (5, words("u")), (5, words("u").upper()), (5, words("x"))]
    rows += [(None, words("n")), (None, words("n")), (None, words("a")), (8, ""), (8, ""), (9, "")]
    frame = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, source string").repartition(4)
    got = sorted(((r.doc_id, r.text.lower()) for r in drop_near_duplicates(frame).collect()), key=str)
    assert got == sorted([(3, words("a")), (5, words("u")), (5, words("x")), (None, words("n")), (8, ""), (9, "")], key=str)
    assert drop_near_duplicates(frame.limit(0)).isEmpty()


def test_columns_with_clashing_names_stay(spark):
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, text, 7.5, "h", 3), (2, text, 8.5, "i", 4), (3, "something else entirely that is long enough to be kept", 9.5, "j", 5)]
    out = drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, _key double, _hash string, c0 int"))
    assert sorted(tuple(r) for r in out.collect()) == [rows[0], rows[2]]


def test_copies_changed_each_in_its_own_way_meet_nobody(spark, monkeypatch):
    """A large group around one text whose members are linked with the centre at best: pairs grow with it, not with its square."""
    rng = random.Random(12)
    base = [f"w{i}" for i in range(100)]
    made = []
    pairs = near_dup._open_pairs
    monkeypatch.setattr(near_dup, "_open_pairs", lambda rows, percent: made.append(pairs(rows, percent)) or made[-1])
    for n in (100, 200):
        rows = [(0, " ".join(base))]
        for i in range(1, n):
            words = list(base)
            for k in rng.sample(range(100), 3):
                words[k] = f"x{i}_{k}"
            rows.append((i, " ".join(words)))
        got = {r["doc_id"]: r["component_id"] for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert made[-1].count() <= n
        assert got == expected_components(rows)


def expected_components(rows, width=5, percent=80):
    sets = {i: {tuple(w[k : k + width]) for w in [t.split()] for k in range(len(w) - width + 1)} for i, t in rows}
    component = {i: i for i in sets}
    changed = True
    links = [(i, j) for i in sets for j in sets if i < j and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    while changed:
        changed = False
        for i, j in links:
            low = min(component[i], component[j])
            if component[i] != low or component[j] != low:
                component[i] = component[j] = low
                changed = True
    return component


@pytest.mark.parametrize("shared, made", [(5, []), (9, []), (10, [(1, 2)])])
def test_a_pair_is_made_only_if_it_met_in_as_many_items_as_a_link_takes(spark, shared, made):
    """Members of 77 shingles that differ from the centre in 12 and 24 are linked if and only if they share 10 of these."""
    near = list(range(12))
    far = [*range(shared), *range(100, 124 - shared)]
    rows = [(0, b, b, 0, 77, len(x), np.array(x, np.int64).tobytes()) for b, x in enumerate([[], near, far])]
    differences = spark.createDataFrame(rows, "a long, b long, part long, core long, n long, s long, delta binary")
    assert [tuple(r) for r in near_dup._open_pairs(near_dup._with_hub(differences, 80), 80).collect()] == made


@pytest.mark.parametrize("shared, rows", [(5, 0), (9, 0), (10, 1), (12, 3)])
def test_members_meet_only_in_items_with_enough_left_to_share(spark, shared, rows):
    """Those of 77 shingles that differ from the centre in 12 and 24 meet where 10 shared items are left: not in each of the rarest."""
    far = [*range(shared), *range(100, 124 - shared)]
    members = [(0, b, b, 0, 77, len(x), np.array(x, np.int64).tobytes()) for b, x in enumerate([[], [*range(12)], far])]
    differences = spark.createDataFrame(members, "a long, b long, part long, core long, n long, s long, delta binary")
    assert near_dup._met(near_dup._with_hub(differences, 80), 80).count() == rows


def test_few_texts_that_are_no_candidates_are_shuffled(spark):
    texts = spark.range(-20_000, 20_000).select("id", near_dup.F.lit("some text").alias("text"))
    wanted = [*range(-20_000, 20_000, 40), 1 << 62]
    ids = {r.id for r in near_dup._narrowed(texts, spark.createDataFrame([(i,) for i in wanted], "id long")).collect()}
    assert ids >= set(wanted[:-1])
    assert len(ids) < 1100
    assert near_dup._narrowed(texts, spark.createDataFrame([], "id long")).isEmpty()


@pytest.mark.parametrize("links", [set(range(1, 51)), {17}, set()])
def test_two_linked_components_are_not_compared_member_by_member(spark, links):
    parts = spark.createDataFrame([(i, 1) for i in range(1, 51)], "node long, component long")
    pairs = spark.createDataFrame([(i, 100) for i in range(1, 51)], "a long, b long")
    asked = []

    def confirm(some):
        asked.append(some.count())
        return some.filter(some.a.isin([*links] or [0])).select("a", "b")

    found = near_dup._confirmed(pairs, parts, confirm, 4)
    assert {r.a for r in found.collect()} <= links and (found.count() > 0) == bool(links)
    assert asked in ([[4], [4, 46]] if links == {17} else [[4]] if links else [[4, 46]])
    assert near_dup._confirmed(pairs.limit(0), parts, confirm, 4) is None


def test_tables_of_ids_are_few_files(spark):
    """Small partitions that adaptive execution leaves as they are: each would be a file, and each file starts processes on a local disk."""
    conf = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    rows, files = corpus(8), {}
    with workspace.work_scope() as folders:
        try:
            for k, v in conf.items():
                spark.conf.set(k, v)
            got = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), NearSpec(words=4)).collect()}
        finally:
            for k, v in before.items():
                spark.conf.set(k, v)
        for f in folders:
            name = Path(f.removeprefix("file:")).name.split("-")[0]
            files[name] = max(files.get(name, 0), len([*Path(f.removeprefix("file:")).glob("*.parquet")]))
    assert got == {i: c for i, (_, c) in brute(rows, 4).items()}
    ids = {"pairs", "links", "stars", "open", "first", "found", "rest", "wanted"}
    assert ids <= set(files) and all(files[x] <= 4 for x in ids)


def test_sets_of_many_texts_are_made_some_at_a_time():
    text = " ".join(f"w{i}" for i in range(1500))
    column = pa.array([text] * 200)
    list(near_dup._each_set(column, 5))  # tables that stay are made
    tracemalloc.start()
    try:
        sizes = [len(x) for x in near_dup._each_set(column, 5)]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sizes == [1496] * 200
    assert peak < 12 * len(text) * len(column)
