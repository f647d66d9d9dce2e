import random
import re

import zstandard
from hourloom.llm.compression import Bands, quality_filter, quality_signals

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text: str | None, bands: Bands):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    count = {}
    for i in range(len(words) - 7):
        count.setdefault(tuple(words[i : i + 8]), []).append(i)
    cover = {j for at in count.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    base = len(words) < 20 or 100 * len(cover) > 30 * len(words)
    raw = text.encode()
    pack = zstandard.ZstdCompressor(level=bands.level).compress
    failed = False
    if raw:
        low, high = next((a, b) for limit, a, b in bands.limits if len(raw) < limit)
        chunks = [raw[i : i + bands.chunk_bytes] for i in range(0, len(raw) - bands.chunk_bytes + 1, bands.chunk_bytes)]
        bad = sum(not bands.chunk_band[0] <= len(c) / len(pack(c)) <= bands.chunk_band[1] for c in chunks)
        failed = not low <= len(raw) / len(pack(raw)) <= high or bad > bands.chunk_share * len(chunks)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cover), base, not base and not failed


def corpus():
    rng = random.Random(5)
    words = ["alpha", "béta", "gämma", "delta", "x", "日本語", "# a", "word\x0bword", "two parts"]
    texts = [None, "", " ", "\n\n", "one", "a " * 40, "line one is here\n" * 30, "\r\nsame\r\nsame\n", "日本 " * 25]
    for n in (5, 19, 20, 60, 300, 4000):
        texts += [" ".join(rng.choice(words) for _ in range(n)) for _ in range(3)]
        texts += ["\n".join(" ".join(f"w{rng.randrange(400)}" for _ in range(9)) for _ in range(n // 9 + 1))]
    texts.append("".join(chr(rng.randrange(33, 0x2FFF)) + " " * (rng.random() < 0.2) for _ in range(9000)))
    return [*texts, texts[-1], "x" * 3_000_000]


def test_signals_equal_brute_force(spark):
    texts = corpus()
    rows = [(i if i != 3 else None, t, i) for i, t in enumerate(texts)]
    got = quality_signals(spark.createDataFrame(rows, "doc_id long, text string, n_words long")).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i, t, _ in rows:
        r = by_id[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) == brute(t, Bands()), (i, (t or "")[:60])


def test_filter_keeps_columns_and_clean_text(spark):
    rng = random.Random(1)
    clean = " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9))) for _ in range(400))
    rows = [(1, clean, 7), (2, "spam spam " * 300, 8), (3, None, 9), (4, clean, 10)]
    out = quality_filter(spark.createDataFrame(rows, "doc_id long, text string, kept long"))
    assert out.columns == ["doc_id", "text", "kept"]
    assert sorted(r.doc_id for r in out.collect()) == [1, 4]


def test_empty_table(spark):
    assert quality_signals(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_a_text_goes_to_python_once_and_failed_rows_do_not_return(spark):
    out = quality_filter(spark.createDataFrame([(1, "x", "en")], "doc_id long, text string, lang string"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    sent = plan[plan.index("MapInArrow") :]
    assert len(set(re.findall(r"text#(\d+) AS (k\d+|t)#", sent))) == 1 and "Filter" not in plan
