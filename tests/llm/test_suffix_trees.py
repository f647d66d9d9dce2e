"""Repeated word windows against their definition."""

import hashlib
import random
import re

import numpy as np
import pytest

from hourloom.llm import suffix_trees
from hourloom.llm.queries import ORACLES, QUERIES
from hourloom.llm.suffix_trees import WindowSpec
from hourloom.llm.workers import share_package
from tools.check import compare, open_tables

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def expected(rows, width):
    """Sorted (id, n_words, n_removed, kept text) by the definition."""
    words = [(i, WORDS.findall(t or "")) for i, t in rows]
    big = 1 << 62
    least = {}
    for i, w in words:
        for a in range(len(w) - width + 1):
            key = tuple(w[a : a + width])
            least[key] = min(least.get(key, big), big if i is None else i)
    out = []
    for i, w in words:
        gone = np.zeros(len(w), bool)
        for a in range(len(w) - width + 1):
            if least[tuple(w[a : a + width])] < (big if i is None else i):
                gone[a : a + width] = True
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((str(i), len(w), int(gone.sum()), kept))
    return sorted(out)


def found(df):
    return sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect())


def hashed(rows):
    return sorted((i, n, m, hashlib.sha256(t.encode()).hexdigest()) for i, n, m, t in rows)


def invented(seed, n=80):
    """Few different words, shared passages and copies, white space of all kinds."""
    rng = random.Random(seed)
    passages = [[rng.choice("abcdefgh") for _ in range(rng.randint(3, 40))] for _ in range(6)]
    rows = []
    for i in range(n):
        w = []
        while len(w) < rng.choice([0, 4, 20, 90]):
            w += rng.choice(passages) if rng.random() < 0.5 else [f"w{rng.randint(0, 400)}é" for _ in range(rng.randint(1, 9))]
        rows.append((rng.randint(0, 10**6) * 10 + i % 10, rng.choice([" ", "\n", " \t "]).join(w)))
    rows += [(10**8 + k, rows[3][1]) for k in range(30)]
    return rows


@pytest.fixture(autouse=True)
def package(spark):
    share_package(spark)


@pytest.mark.parametrize("spec", [WindowSpec(), WindowSpec(heavy=2), WindowSpec(width=6, anchor=2, heavy=5, bundle_bytes=200), WindowSpec(width=5, anchor=5)])
def test_equals_definition(spark, spec):
    rows = invented(2)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(suffix_trees.repeated_windows(df, spec)) == hashed(expected(rows, spec.width))


def test_nulls_repeated_rows_and_other_columns(spark):
    base = " ".join(f"v{i}" for i in range(40))
    rows = [(4, base), (4, base), (None, base), (None, None), (9, ""), (9, base + " more"), (2, " \n\t"), (11, "x " * 30)]
    df = spark.createDataFrame([(*r, 7.5, "k", [1]) for r in rows], "doc_id long, text string, id double, hash string, spans array<int>")
    want = expected(rows, 13)
    assert found(suffix_trees.repeated_windows(df)) == hashed(want)
    out = suffix_trees.remove_windows(df)
    assert out.columns == df.columns
    assert sorted((str(r["doc_id"]), r["text"]) for r in out.collect()) == [(i, t) for i, _, _, t in want]
    assert {(r["id"], r["hash"]) for r in out.collect()} == {(7.5, "k")}
    assert suffix_trees.repeated_windows(df.limit(0)).collect() == []


def test_a_very_long_text(spark):
    rng = random.Random(5)
    long = " ".join(f"u{rng.randint(0, 10**6)}" for _ in range(400_000))
    rows = [(1, long), (2, long[1_000_000:1_500_000]), (3, "word " * 300_000), (4, "word " * 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in suffix_trees.repeated_windows(df).collect()}
    assert got[1]["n_removed"] == 0 and got[2]["n_removed"] >= got[2]["n_words"] - 2
    assert got[3]["n_removed"] == 0 and got[4]["n_removed"] == 20


def test_deep_nodes():
    rng = np.random.default_rng(3)
    word = rng.integers(0, 3, 400)
    start, root, least = np.arange(390), rng.integers(0, 2, 390), rng.integers(0, 1000, 390)
    want = {}
    for s, r, v in zip(start, root, least, strict=True):
        key = (r, *word[s : s + 7])
        want[key] = min(want.get(key, 10**9), v)
    got = suffix_trees.deep_nodes(word, start, root, least, 7)
    assert [want[(r, *word[s : s + 7])] for s, r in zip(start, root, strict=True)] == got.tolist()


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert not compare(QUERIES["op11_suffix_trees"](spark, folder), open_tables(folder), ORACLES["op11_suffix_trees"])
