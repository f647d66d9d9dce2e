import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hourloom.llm import suffix_dedup
from hourloom.llm.suffix_dedup import RepeatSpec, remove_repeats, repeated_spans, suffix_order, window_classes
from hourloom.llm.textbytes import text_slices


def brute(rows, length):
    """Least id of every string of the given length, then what each row loses."""
    least = {}
    big = 1 << 70
    for i, t in rows:
        raw = (t or "").encode()
        for k in range(len(raw) - length + 1):
            w = raw[k : k + length]
            least[w] = min(least.get(w, big), big if i is None else i)
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        gone = [False] * len(raw)
        for k in range(len(raw) - length + 1):
            if least[raw[k : k + length]] < (big if i is None else i):
                gone[k : k + length] = [True] * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out.append((i, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abcdé ßxyz\n") for _ in range(rng.randrange(30, 200))) for _ in range(12)]
    texts = [None, "", "short", "a" * 300, "a" * 120, "ab" * 90, "日本語" * 40]
    for _ in range(150):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            parts.append(rng.choice([p, p[a:], p[:a], "".join(rng.choice("klmnop ") for _ in range(rng.randrange(1, 60)))]))
        texts.append("".join(parts))
    texts += [texts[40]] * 5 + ["a" * 200]
    rng.shuffle(texts)
    return [(None if i == 3 else i * 3, t) for i, t in enumerate(texts)] + [(9, texts[3]), (9, texts[3])]


@pytest.mark.parametrize("heavy", [20_000, 3])
def test_spans_equal_brute_force(spark, heavy):
    rows = corpus(heavy)
    spec = RepeatSpec(heavy=heavy, sort_bytes=700)
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, block string").repartition(6)
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeated_spans(frame, spec).collect()), key=str)
    assert got == brute(rows, 50)


def test_other_columns_stay_and_empty_table(spark):
    passage = "The same words stand in both of these rows and are long enough to count. "
    rows = [(2, 1.5, passage + "second", "k"), (1, None, passage + "first", None)]
    out = remove_repeats(spark.createDataFrame(rows, "doc_id long, body double, text string, index string"))
    assert out.columns == ["doc_id", "body", "text", "index"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, None, passage + "first", None), (2, 1.5, "second", "k")]
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_suffixes_sort_like_strings():
    rng = np.random.default_rng(4)
    for size, letters in ((1, 2), (2, 1), (5, 2), (40, 1), (300, 2), (900, 3), (1000, 200)):
        text = (rng.integers(0, letters, size) + 97).astype(np.uint8)
        raw = text.tobytes()
        order = suffix_order(text, 64)
        assert sorted(order.tolist()) == list(range(size))
        heads = [raw[i : i + 50] for i in order]
        assert heads == sorted(heads)
        if size >= 60:
            starts = np.arange(size - 50)
            classes = window_classes(text, starts, 50)
            by_text = {}
            assert all(by_text.setdefault(raw[i : i + 50], c) == c for i, c in zip(starts, classes, strict=True))
            assert len(by_text) == len(set(classes.tolist()))


def test_frames_return_what_they_were_given():
    rows = (np.array([3, 1], np.int32), np.array([2**63, 5], np.uint64), np.array([], np.uint8))
    for squeeze in (False, True):
        bodies = [suffix_dedup._frame(*rows, squeeze=squeeze), suffix_dedup._frame(*rows, squeeze=squeeze)]
        got, sizes = suffix_dedup._together(bodies, np.int32, np.uint64, np.uint8, squeezed=squeeze)
        assert [x.tolist() for x in got] == [[3, 1, 3, 1], [2**63, 5, 2**63, 5], []] and sizes.tolist() == [2, 2]
    assert len(suffix_dedup._frame(np.arange(3, dtype=np.uint32), np.ones(3, np.uint16))) == 2 * 8 + 3 * 6


def test_a_block_takes_few_times_its_bytes():
    """Two workers of an executor hold a block's arrays each, 16 MB for every 8 bytes a byte of text."""
    text = random.Random(4).randbytes(1 << 17).hex()
    block = next(text_slices(pa.array([text, "", text[:70], None, "x" * 49]), 1 << 62))
    suffix_dedup._Runs(block, RepeatSpec())  # tables that stay are made
    tracemalloc.start()
    try:
        runs = suffix_dedup._Runs(block, RepeatSpec())
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 42 * len(block.data)
    assert runs.count.sum() == len(text) - 49 + 21


def test_least_prints_of_tiles_are_those_of_the_whole_block():
    rng = random.Random(8)
    texts = ["", "x" * 49, "y" * 50, None, rng.randbytes(400).hex(), "ab" * 60, "z"]
    spec = RepeatSpec()
    block = next(text_slices(pa.array(texts), 1 << 62))
    runs = suffix_dedup._Runs(block, spec)
    raw = block.data.tobytes()
    prints = block.spread_hashes(runs.sums, 20)
    least = [prints[i : i + 31].min() for i in range(len(raw) - 49)]
    for tile in (1, 7, 1 << 15):
        assert runs.least_prints(block, spec, tile).tolist() == least
    windows = [i for a, b in zip(block.edges[:-1], block.edges[1:], strict=True) for i in range(a, b - 49)]
    assert [i for a, n in zip(runs.start, runs.count, strict=True) for i in range(a, a + n)] == windows
    for a, n in zip(runs.start.tolist(), runs.count.tolist(), strict=True):
        assert len(set(least[a : a + n])) == 1
        assert a - 1 not in windows or least[a - 1] != least[a] or a in block.edges


def test_names_of_rows_are_dense_ranks():
    """One sort of a number that holds all keys, also where they do not fit into one at once."""
    rng = np.random.default_rng(3)
    for high in (3, 1 << 20, 1 << 31):
        keys = [rng.choice(rng.integers(0, high, 30), 500) for _ in range(3)]
        ranks, order = suffix_dedup._names(*keys)
        rows = list(zip(*(k.tolist() for k in keys), strict=True))
        place = {r: i for i, r in enumerate(sorted(set(rows)), 1)}
        assert ranks.tolist() == [place[r] for r in rows]
        assert [rows[i] for i in order] == sorted(rows)
    assert suffix_dedup._names(np.array([1 << 63, 5, 1 << 63], np.uint64))[0].tolist() == [2, 1, 2]


def test_runs_of_a_block_need_no_array_for_each_step():
    text = random.Random(4).randbytes(1 << 18).hex()
    block = next(text_slices(pa.array([text]), 1 << 62))
    suffix_dedup._Runs(block, RepeatSpec())  # tables that stay are made
    tracemalloc.start()
    try:
        suffix_dedup._Runs(block, RepeatSpec())
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 28 * len(block.data)
