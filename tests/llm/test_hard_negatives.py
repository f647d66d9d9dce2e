"""Mined negatives against a search through all rows."""

import math

import numpy as np
import pytest

from hourloom.llm import hard_negatives
from hourloom.llm.hard_negatives import MiningSpec, multi_sequence, products
from hourloom.llm.queries import ORACLES, QUERIES
from hourloom.llm.workers import share_package
from tools.check import compare, open_tables

SCHEMA = "vec_id long, embedding array<float>, label int"
SMALL = MiningSpec(codewords=8, regions=4, first_rows=20, growth=3, block_rows=16, region_rows=64, anchor_rows=3, sample=100)


def expected(rows, step=5, scale=256):
    rows = [r for r in rows if None not in r and all(x is not None and math.isfinite(x) for x in r[1])]
    dims = max((len(r[1]) for r in rows), default=0)
    distinct = {}
    for i, x, label in rows:
        q = tuple(math.floor(scale * float(np.float32(v))) for v in x) + (0,) * (dims - len(x))
        distinct[(i, label, q)] = None
    out = []
    for i, label, q in distinct:
        if i % step:
            continue
        scored = [(-sum(a * b for a, b in zip(q, p, strict=True)), j, k == label) for j, k, p in distinct if j != i]
        for ps, positive, _ in sorted(x for x in scored if x[2])[:5]:
            fits = sorted((s, j) for s, j, same in scored if not same and 80 * -ps <= 100 * -s <= 100 * -ps)[:5]
            out += [(i, positive, rank + 1, j, -ps, -s) for rank, (s, j) in enumerate(fits)]
    return sorted(out)


def mined(spark, rows, spec=SMALL, step=5):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    return sorted(tuple(r) for r in hard_negatives.mine(df, f"vec_id % {step} = 0", spec).collect())


def invented(seed, n=160, dims=6, spread=0.3):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(5, dims))
    return [(int(i) * 3, [float(x) for x in middles[i % 5] + spread * rng.normal(size=dims)], int(rng.integers(0, 3))) for i in range(n)]


@pytest.fixture(autouse=True)
def package(spark):
    share_package(spark)


def test_equals_search_through_all(spark):
    rows = invented(1)
    want = expected(rows)
    assert len(want) > 100
    assert mined(spark, rows) == want


def test_sample_and_cells_do_not_change_the_answer(spark):
    rows = invented(2, spread=1.0)
    want = expected(rows)
    assert mined(spark, rows, MiningSpec(codewords=4, regions=2, sample=5, first_rows=1, growth=50, block_rows=1000)) == want
    assert mined(spark, rows, MiningSpec()) == want


def test_ties_hot_vectors_and_repeated_rows(spark):
    """A third of all rows have one vector; whole rows are repeated; every score ties."""
    one = [0.5, -0.25, 1.0]
    rows = [(i, one, i % 3) for i in range(90)] + [(i, one, i % 3) for i in range(30)] + [(200 + i, [0.1 * (i % 7), 0.2, 0.3], i % 4) for i in range(90)]
    assert mined(spark, rows) == expected(rows)


def test_rows_that_take_no_part(spark):
    rows = invented(4, n=40) + [(1000, None, 1), (1005, [1.0] * 6, None), (None, [1.0] * 6, 1), (1010, [1.0, None, 1.0], 1), (1015, [float("nan")] * 6, 0), (1020, [float("inf")] * 6, 0)]
    rows += [(1025, [], 1), (1030, [2.0, 1.0], 1), (1035, [1e6] * 6, 2), (1040, [1e6] * 6, 1), (1045, [-1e6] * 6, 2)]
    assert mined(spark, rows) == expected(rows)


def test_empty_tables_no_anchors_and_other_columns(spark):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in invented(5, n=30)], SCHEMA + ", id string, cell int, a int")
    assert hard_negatives.mine(df.limit(0), "true", SMALL).collect() == []
    assert hard_negatives.mine(df, "vec_id < 0", SMALL).collect() == []
    assert hard_negatives.mine(df.withColumn("label", df["vec_id"].cast("int")), "true", SMALL).collect() == []
    assert sorted(tuple(r) for r in hard_negatives.mine(df, "vec_id % 5 = 0", SMALL).collect()) == expected(invented(5, n=30))


def test_multi_sequence_falls_and_is_whole():
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=7), rng.normal(size=5)
    pairs = list(multi_sequence(x, y))
    assert len({(i, j) for _, i, j in pairs}) == 35
    assert [round(b, 9) for b, _, _ in pairs] == sorted((round(a + b, 9) for a in x for b in y), reverse=True)


@pytest.mark.parametrize("top", [100, 10**6, 10**9])
def test_products_are_exact(top):
    rng = np.random.default_rng(top)
    a, b = (rng.integers(-top, top, (4, 9)).astype(float) for _ in range(2))
    assert products(a, b).tolist() == [[min(max(sum(int(x) * int(y) for x, y in zip(r, s, strict=True)), -(2**63)), 2**63 - 1) for s in b] for r in a]


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert not compare(QUERIES["op12_multi_index"](spark, folder), open_tables(folder), ORACLES["op12_multi_index"])
