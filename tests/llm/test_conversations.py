"""Conversation repair against a plain search over whole conversations."""

import hashlib
import itertools
import random
import zlib

import pytest

from hourloom.llm import conversations
from hourloom.llm.queries import QUERIES
from hourloom.llm.workers import share_package

WHITE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string"


def damaged(rows):
    space = lambda v: " " if v is None else str(v)
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = text.translate(str.maketrans("", "", ".!?"))
        if kind == 4:
            role = "user"
        for _ in range(2 if kind == 3 else 1):
            yield conv, turn, role, text


def cheapest(rows):
    """(cost, audit, repaired lines) of the cheapest repair, the least audit among equals."""
    best = [(0, "", []) if s in ("", "a") else None for s in ("", "s", "u", "a")]
    states = {"": 0, "s": 1, "u": 2, "a": 3}
    legal = {("", "s"), ("", "u"), ("s", "u"), ("a", "u"), ("u", "a")}

    def least(options):
        options = [x for x in options if x is not None]
        return min(options, key=lambda x: x[:2]) if options else None

    def inserted(best):
        for _ in range(4):
            new = []
            for state in states:
                options = [best[states[state]]]
                for role, name in (("u", "user"), ("a", "assistant")):
                    behind = best[states[role]]
                    if (state, role) in legal and behind:
                        options.append((behind[0] + 3, "I" + behind[1], [f"{name}:"] + behind[2]))
                new.append(least(options))
            best = new
        return best

    best = inserted(best)
    for role, text, fault in reversed(rows):
        new = []
        for state in states:
            options = []
            if best[states[state]]:
                c, a, lines = best[states[state]]
                options.append((c + 4, "D" + a, lines))
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault == "truncated" else 0
                for edit, cost, new_role in (("K", 0, role), ("R", 3, "user"), ("R", 3, "assistant")):
                    behind = best[states[new_role[:1]]] if (state, new_role[:1]) in legal else None
                    if behind:
                        options.append((behind[0] + cost + extra, edit + behind[1], [f"{new_role}:{text}"] + behind[2]))
            new.append(least(options))
        best = inserted(new)
    return best[0]


def expected(rows, ids=None):
    out = {}
    for conv in ids if ids is not None else {r[0] for r in rows}:
        mine = [r[1:] for r in rows if r[0] == conv]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        seen, sums, faults = set(), dict.fromkeys(("blank", "duplicate", "truncated"), 0), []
        for _, role, text in mine:
            solid = text.rstrip(WHITE)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append((role, text, fault))
            if fault:
                sums[fault] += 1
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(mine))
        turns = {r[0] for r in mine if r[0] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        cost, audit, lines = cheapest(faults)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, *sums.values(), illegal, cost, audit, digest)
    return out


def found(df):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    rows = df.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r[n] for n in names) for r in rows}


def invented(seed, n_convs, longest):
    rng, rows = random.Random(seed), []
    for conv in range(n_convs):
        for turn in sorted(rng.sample(range(longest * 2), rng.randint(1, longest))):
            role = rng.choice(["user", "user", "assistant", "assistant", "system", "tool", "", "umpire", "sage"])
            rows.append((conv, turn, role, rng.choice(["Yes.", "No", "Hm? ", " \t", "", "Well!\n", f"{rng.random()}", f"{rng.random()}.", "é…", "ends. \x0b"])))
    return rows


@pytest.fixture(autouse=True)
def package(spark):
    share_package(spark)


@pytest.mark.parametrize("segment_rows", [3, 512])
def test_equals_plain_search(spark, segment_rows):
    rows = invented(1, 60, 6) + [(1000 + c, *r) for c, r in enumerate([(0, "user", "a."), (0, "assistant", "b.")])]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert found(conversations.repair(df, segment_rows)) == expected(rows)


def test_one_long_conversation_over_many_segments(spark):
    rows = [(5, *r[1:]) for r in invented(3, 1, 400)] + invented(4, 3, 5)
    rows = [(c, i, *r) for i, (c, _, *r) in enumerate(rows)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(conversations.repair(df, 16)) == found(conversations.repair(df)) == expected(rows)


def test_repeated_rows_are_one_run(spark):
    """Many equal rows of one turn: one stays, the others are duplicates, also across segments."""
    rows = [(1, 0, "user", "same.")] * 40 + [(1, 1, "assistant", "fine.")] + [(2, None, "user", "x")] * 3 + [(2, 4, "user", "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    out = found(conversations.repair(df, 8))
    assert out == expected(rows)
    assert out[1][2] == 39 and out[2][0] == 0 and out[2][2] == 3


def test_nulls_other_columns_and_an_empty_table(spark):
    rows = [(None, None, None, None), (None, 3, "user", None), (7, None, "user", "Hi."), (7, 2, None, "there."), (8, 1, "assistant", "A" * 3_000_000 + ".")]
    df = spark.createDataFrame([(*r, "x", 1, 2.5) for r in rows], SCHEMA + ", conv string, _conv int, place double")
    space = lambda v: " " if v is None else v
    assert found(conversations.repair(df)) == expected([(c, t, space(r), space(x)) for c, t, r, x in rows])
    assert conversations.repair_all(df.limit(0), conversations.damage(df.limit(0))).collect() == []


def test_damage_and_lost_conversations(spark):
    rows = invented(9, 80, 5)
    df = spark.createDataFrame(rows, SCHEMA)
    hurt = list(damaged(rows))
    got = conversations.damage(df)
    assert sorted(tuple(r) for r in got.collect()) == sorted(hurt)
    ids = {r[0] for r in rows}
    out = found(conversations.repair_all(df, got))
    assert out == expected(hurt, ids)
    assert any(v == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) for v in out.values())


def test_query_equals_plain_search(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(QUERIES["op13_conversation_dawg"](spark, folder)) == expected(list(damaged(rows)), {r[0] for r in rows})
