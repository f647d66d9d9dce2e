import random
import re

import pytest
from hourloom.llm.licenses import NOTICES, PHRASES, Template, compile_template, scan, words_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def as_regex(markup):
    """The template as a regular expression over words, each followed by a space."""
    markup = re.sub(r"<<beginOptional>>", " ( ", markup)
    markup = re.sub(r"<<endOptional>>", " ) ", markup)
    markup = re.sub(r"<<var;name=\w+;match=\.(\{\d+,\d+\})>>", r" V\1 ", markup)
    out = ""
    for part in markup.split():
        out += {"(": "(?:", ")": ")?"}.get(part) or (f"(?:[^ ]+ ){part[1:]}" if part[0] == "V" and part[1] == "{" else re.escape(part) + " ")
    return re.compile(out)


PATTERNS = [(t, as_regex(t.markup)) for t in PHRASES + NOTICES]


def brute(text):
    words = WORD.findall((text or "").translate(LOWER))
    line = "".join(w + " " for w in words)
    begins = [sum(len(w) + 1 for w in words[:i]) for i in range(len(words))]
    hits = [(t.label, i, t.base) for i, b in enumerate(begins) for t, p in PATTERNS if p.match(line, b)]
    base = [i for _, i, is_base in hits if is_base]
    return (
        len(words), len(base), min(base, default=None), max(base, default=None),
        ",".join(sorted({x for x, _, b in hits if b})), ",".join(sorted({x for x, _, _ in hits})),
    )


def corpus():
    rng = random.Random(8)
    vocabulary = sorted({w for t in PHRASES + NOTICES for w in re.sub(r"<<[^>]*>>", " ", t.markup).split()} | {"é", "x9", "2", "0", "c", "the", "License"})
    texts = [None, "", "MIT", "mit-license", "MIT\nLicense, MIT  LICENSE", "Permit license", "mit licenses", "Apache License 2.0; GNU General Public License, version 3.", "mit mit license"]
    texts += ["Licensed under CC BY-NC 4.0.", "Copyright (c) 2020 Jane Doe. All rights reserved.", "Copyright " + "a " * 13 + "all rights reserved", "Released under the MIT License."]
    for t in PHRASES + NOTICES:
        for _ in range(6):
            body = re.sub(r"<<beginOptional>>(.*?)<<endOptional>>", lambda m: m[1] if rng.random() < 0.5 else "", t.markup)
            body = re.sub(r"<<var[^>]*\{(\d+),(\d+)\}>>", lambda m: " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(int(m[1]), int(m[2]) + 2))), body)
            words = body.split()
            if rng.random() < 0.3:
                words.pop(rng.randrange(len(words)))
            texts.append(" ".join([*rng.choices(vocabulary, k=5), *words, *rng.choices(vocabulary, k=5)]))
    texts += [" ".join(rng.choices(vocabulary, k=rng.randrange(1, 80))) for _ in range(100)]
    return [*texts, "word " * 30_000 + "mit license"]


def test_scan_equals_regular_expressions(spark):
    rows = list(enumerate(corpus()))
    frame = spark.createDataFrame([(*r, 1) for r in rows] + [(None, "mit license", 2)], "doc_id long, text string, spans int").repartition(4)
    got = {r.doc_id: r for r in scan(frame).collect()}
    assert got.pop(None).labels == "mit"
    for i, t in rows:
        r = got[i]
        if t and len(t) > 100_000:
            assert (r.n_words, r.n_base, r.first_word, r.last_word, r.labels) == (30_002, 1, 30_000, 30_000, "mit")
            continue
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) == brute(t), t
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


def test_empty_table_and_wrong_templates(spark):
    assert scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    for markup in ("", "<<beginOptional>>only<<endOptional>>", "<<var;name=x;match=.{1,2}>> word", "a <<beginOptional>> b"):
        with pytest.raises(ValueError):
            compile_template(Template("x", markup)).first_words()
    assert words_of("Ä-b C_d\x00e9".encode()) == ["Ä".encode(), b"b", b"c", b"d", b"e9"]
