import json
import random
import struct
import uuid
import zlib
from pathlib import Path

import public_tokenizers
import pyarrow as pa
import pyarrow.orc
from hourloom.llm.textbytes import text_slices
from hourloom.llm.token_store import TokenSpec, _Encoder, goes_by_words, read_tokens, token_report, units_of, write_tokens
from tokenizers import Tokenizer

MODEL = public_tokenizers.path("word_bpe_49k.json")


def corpus():
    rng = random.Random(6)
    texts = [None, "", " \n\t", "It's a test, don't you think? We'll see.", "état ÉTAT e ́", "日本語　テキスト 12345", "a\x1cb\x85c d e", "<|endoftext|> x<|startoftext|>y", "ΑΣ ΣΑΣ. İstanbul ﬁn", "x" * 5000, "🙂🙂 👩‍👩‍👧 ok"]
    alphabet = "abcdefgh'sté ñß.,!0123456789 \n\t"
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 700))) for _ in range(200)]
    rng.shuffle(texts)
    return [(i * 3 - 100, t) for i, t in enumerate(texts)]


def test_files_hold_what_the_library_gives(spark, tmp_path):
    rows = corpus()
    frame = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, ids string").repartition(7)
    path = f"{tmp_path}/{uuid.uuid4().hex}"
    write_tokens(frame, path, MODEL, TokenSpec(cached_words=50))
    library = Tokenizer.from_file(MODEL)
    want, start = {}, 0
    for i, t in sorted(rows):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        want[i] = (start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)
    tokens = read_tokens(spark, path)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_report(tokens).collect()} == want
    # ascending inside and across files, and pruned by id
    seen = []
    for file in sorted(tmp_path.rglob("*.orc")):
        ids = pyarrow.orc.read_table(file).column("doc_id").to_pylist()
        assert ids == sorted(ids)
        seen += ids
    assert seen == sorted(seen) and len(seen) == len(rows)
    some = read_tokens(spark, path, [rows[3][0], rows[50][0], 10_000])
    assert sorted(r.doc_id for r in some.collect()) == sorted([rows[3][0], rows[50][0]])
    assert "PushedFilters: [In(doc_id" in some._jdf.queryExecution().toString()


def test_null_ids_repeated_rows_and_empty_table(spark, tmp_path):
    rows = [(None, "one"), (None, "one"), (5, "two words"), (5, "two words"), (5, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    write_tokens(frame, f"{tmp_path}/a", MODEL)
    got = token_report(read_tokens(spark, f"{tmp_path}/a")).collect()
    assert sorted(r.start for r in got)[0] == 0 and len(got) == 5
    assert [r.n_tokens for r in sorted(got, key=lambda r: r.start)][:2] == [2, 2]
    write_tokens(frame.limit(0), f"{tmp_path}/b", MODEL)
    assert token_report(read_tokens(spark, f"{tmp_path}/b")).count() == 0


def test_any_other_tokenizer_gets_whole_texts(spark, tmp_path):
    """A file that cuts texts otherwise has its own ids, not those of the words one by one."""
    model = json.loads(Path(MODEL).read_text())
    assert goes_by_words(model)
    model["pre_tokenizer"] = {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}
    model["normalizer"] = None
    assert not goes_by_words(model)
    other = tmp_path / "other.json"
    other.write_text(json.dumps(model))
    rows = [r for r in corpus()[:60]]
    write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), f"{tmp_path}/o", str(other))
    library = Tokenizer.from_file(str(other))
    got = {r.doc_id: r.ids for r in read_tokens(spark, f"{tmp_path}/o").collect()}
    assert got == {i: [*library.encode(t or "", add_special_tokens=False).ids, 1] for i, t in rows}


def test_a_very_long_text(spark, tmp_path):
    rng = random.Random(2)
    rows = [(1, " ".join(rng.choice(["Word", "it's", "naïve", "10,5", "<|x", "q" * 30]) for _ in range(500_000))), (2, "short"), (3, None)]
    write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), f"{tmp_path}/l", MODEL)
    library = Tokenizer.from_file(MODEL)
    got = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in token_report(read_tokens(spark, f"{tmp_path}/l")).collect()}
    for i, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        assert got[i] == (len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))


def test_letters_beyond_ascii_are_cut_and_remembered_as_ascii_is():
    """Case and punctuation make no new units of words with such letters, and each unit is encoded once."""
    texts = ["Été, ÉTÉ. été!", None, "l'été <|x| 3×4 ½É", "ÀÖØÞ's"]
    block = next(text_slices(pa.array(texts)))
    units, edges = units_of(block)
    found = [u.decode() for u in units.to_pylist()]
    assert [found[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)] == [
        ["été", ",", "été", ".", "été", "!"], [], ["l", "'", "été", "<|x|", "3×4", "½É"], ["àöøþ", "'s"],
    ]
    encoder, library = _Encoder(Path(MODEL).read_text(), 1000), Tokenizer.from_file(MODEL)
    for _ in range(2):
        ids, sizes = encoder(block)
        assert ids.tolist() == [i for t in texts for i in library.encode(t or "", add_special_tokens=False).ids]
        assert sizes.tolist() == [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]
        encoder.tokenizer = encoder.merger = None  # nothing is left to encode


def test_a_letter_that_is_lower_cased_to_a_letter_and_a_mark():
    """The mark belongs to the punctuation that follows."""
    library = Tokenizer.from_file(MODEL)
    texts = ["İ, BİR İ!", "xİ|"]
    ids, _ = _Encoder(Path(MODEL).read_text(), 1000)(next(text_slices(pa.array(texts))))
    assert ids.tolist() == [i for t in texts for i in library.encode(t, add_special_tokens=False).ids]


def test_texts_cut_at_random_equal_the_library():
    rng = random.Random(11)
    parts = [*"abstmdrelv'ABZS .,!<|>0129\n\t\x0b\x1c\x00é É ßÀÞ×÷ÿªº²½¿ \́ΣςçÇİıŒ日\u3000🙂’…", "'s", "'re", "'ll", "'S", "<|endoftext|>", " ", " "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(50))) for _ in range(3000)]
    encoder, library = _Encoder(Path(MODEL).read_text(), 500), Tokenizer.from_file(MODEL)
    for block in text_slices(pa.array(texts), 20_000):
        ids, sizes = encoder(block)
        want = [library.encode(t, add_special_tokens=False).ids for t in texts[block.first : block.first + len(block)]]
        assert sizes.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]
