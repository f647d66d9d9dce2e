import itertools
import random
import re

import numpy as np
from hourloom.llm.packing import PackSpec, best_bounds, pack, pack_plan

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def padding(lengths, counts, bounds):
    return sum(c * (min(b for b in bounds if b >= x) - x) for x, c in zip(lengths, counts, strict=True))


def test_bounds_equal_the_best_of_all_choices():
    rng = random.Random(1)
    for _ in range(200):
        n = rng.randrange(1, 9)
        lengths = sorted(rng.sample(range(1, 60), n))
        counts = [rng.randrange(1, 30) for _ in range(n)]
        buckets = rng.randrange(1, 6)
        got = best_bounds(np.array(lengths), np.array(counts), buckets)
        assert len(got) <= buckets and got[-1] == lengths[-1]
        best = min(padding(lengths, counts, [*x, lengths[-1]]) for k in range(buckets) for x in itertools.combinations(lengths[:-1], min(k, n - 1)))
        assert padding(lengths, counts, got) == best
    assert best_bounds(np.array([]), np.array([]), 3) == []


def check(rows, spec, got):
    want = {}
    for i, t in rows:
        n = len(WORD.findall(t or ""))
        for p in range(max(1, -(-n // spec.max_length))):
            want.setdefault((i, p, p * spec.max_length, min(spec.max_length, n - p * spec.max_length)), 0)
            want[i, p, p * spec.max_length, min(spec.max_length, n - p * spec.max_length)] += 1
    have = {}
    for r in got:
        have[r.doc_id, r.piece, r.first_word, r.length] = have.get((r.doc_id, r.piece, r.first_word, r.length), 0) + 1
    assert have == want
    lengths, counts = np.unique([k[3] for k, n in want.items() for _ in range(n) if k[3]], return_counts=True)
    bounds = best_bounds(lengths, counts, spec.buckets)
    batches = {}
    for r in got:
        if not r.length:
            assert (r.bucket_bound, r.batch, r.slot, r.padding) == (None, None, None, None)
            continue
        assert r.bucket_bound == min(b for b in bounds if b >= r.length) and r.padding == r.bucket_bound - r.length
        batches.setdefault((r.bucket_bound, r.batch), []).append(r.slot)
    for bound in bounds:
        capacity = max(1, spec.batch_tokens // bound)
        own = sorted((b, sorted(slots)) for (x, b), slots in batches.items() if x == bound)
        assert [b for b, _ in own] == list(range(len(own)))
        assert all(slots == list(range(capacity)) for _, slots in own[:-1]) and own[-1][1] == list(range(len(own[-1][1])))


def test_plan_and_texts(spark):
    rng = random.Random(4)
    rows = [(1, None), (2, ""), (None, "a b"), (None, "a b"), (5, "w " * 1000), (6, "same " * 7), (6, "same " * 7)]
    rows += [(i, " ".join(f"v{k}" for k in range(int(rng.paretovariate(0.7)) % 300))) for i in range(10, 600)]
    spec = PackSpec(buckets=5, max_length=64, batch_tokens=500)
    frame = spark.createDataFrame([(*r, 3) for r in rows], "doc_id long, text string, batch int").repartition(6)
    check(rows, spec, pack_plan(frame, spec).collect())
    out = pack(frame.withColumnRenamed("batch", "_at"), spec)
    assert out.columns == ["doc_id", "text", "_at", "piece", "length", "bucket_bound", "batch", "slot", "padding"]
    texts = {i: WORD.findall(t or "") for i, t in rows}
    for r in out.collect():
        assert WORD.findall(r.text or "") == texts[r.doc_id][r.piece * 64 : r.piece * 64 + r.length]


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert pack_plan(frame).count() == 0
    assert pack(frame).count() == 0
