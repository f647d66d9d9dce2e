import random

import corpus_pipeline
import pyarrow as pa
from hourloom.llm import queries
from hourloom.llm.compression import Bands
from hourloom.llm.workers import records_per_batch
from tests.llm import test_compression, test_near_dup, test_suffix_dedup
from tests.llm.test_mixing import WORD, capped_targets

PASSAGE = "this passage of many plain words stands in several documents of the corpus without any change at all and it goes on "


def documents():
    rng = random.Random(21)
    letters = "etaoinshrdlucmfwypvbgk"
    word = lambda: "".join(rng.choices(letters, weights=range(22, 0, -1), k=rng.randrange(2, 9)))
    texts = [" ".join(word() for _ in range(rng.randrange(30, 300))) for _ in range(60)]
    for i in range(0, 20, 4):
        words = texts[i].split()
        words[len(words) // 2] = "changed"
        texts += [texts[i], " ".join(words)]
    for i in range(20, 30):
        texts[i] = texts[i] + " " + PASSAGE + " ".join(word() for _ in range(40))
    texts += ["too short", None, "", "again and again " * 60]
    rng.shuffle(texts)
    return [(i, t, "en", rng.choice(["a", "b", "c", None]), len(t or "")) for i, t in enumerate(texts)]


def test_every_stage_equals_brute_force(spark, tmp_path):
    rows = documents()
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = docs.collect()
        if name != "packing":
            assert docs.columns == [c.split()[0] for c in schema.split(", ")]
    good = {r[0]: r for r in rows if test_compression.brute(r[1], Bands())[-1]}
    assert {r.doc_id: tuple(r) for r in seen["quality rules"]} == good and len(good) > 60
    parts = test_near_dup.brute([(i, r[1]) for i, r in good.items()], 5)
    kept = {i for i, (_, c) in parts.items() if i == c}
    assert {r.doc_id for r in seen["near duplicates"]} == kept and len(kept) < len(good)
    want = {i: removed for i, _, removed, _, _ in test_suffix_dedup.brute([(i, good[i][1]) for i in kept], 50)}
    cleaned = {r.doc_id: r for r in seen["repeated passages"]}
    assert {i: len(good[i][1]) - len(r.text) for i, r in cleaned.items()} == want and sum(want.values()) > 9 * 100
    assert all(r.n_chars == len(r.text) for r in cleaned.values())
    # the mix has each source's target of words, and only words of its documents
    sizes, taken = {}, {}
    for r in cleaned.values():
        sizes[r.source] = sizes.get(r.source, 0) + len(WORD.findall(r.text))
    for r in seen["source mix"]:
        words = WORD.findall(r.text)
        taken[r.source] = taken.get(r.source, 0) + len(words)
        assert set(words) <= set(WORD.findall(cleaned[r.doc_id].text))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    for s, target in zip(order, capped_targets([sizes[s] for s in order], [5, 2, 1, 5][: len(order)], 3), strict=True):
        assert abs(taken[s] - target) <= 0.03 * target + 64
    packed = seen["packing"]
    assert sum(r.length for r in packed) == sum(taken.values())
    assert all(len(WORD.findall(r.text)) == r.length <= r.bucket_bound for r in packed)


def test_all_are_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{n}" for n in range(1, 11)}
    assert set(queries.QUERIES) | {"pipeline"} <= names and set(queries.ORACLES) <= set(entry.oracle_sql())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near duplicates", "repeated passages", "source mix", "packing"]


def test_long_texts_go_to_python_a_megabyte_at_a_time(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])

    texts = spark.range(40, numPartitions=1).selectExpr("repeat('x', 100000) as text")
    with records_per_batch(spark, 10_000, 1 << 30):
        corpus_pipeline.small_batches(spark)
        got = texts.mapInArrow(sizes, "n long, size long").collect()
    assert sum(r.n for r in got) == 40 and max(r.size for r in got) < 1_300_000
