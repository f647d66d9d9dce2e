"""Conversation structure repair on an automaton of role and fault signatures, shared from their ends.

A conversation becomes a word of letters, one a row: its role's initial, its fault. The cheapest repair of a row depends
only on the grammar state before it and on the word from it to the end, so words are read from their ends:

1. Rows are sorted over the cluster by conversation and turn, last turn first; each task writes the words of its rows, cut
   into segments of at most ``segment_rows`` letters, with their counts. A conversation of any length is many segments.
2. Distinct words, in their reversed order, share what they end with. A task that walks through sorted words keeps the path of the last
   one and computes, once a node and grammar state, cost-to-go and best audit suffix.
3. Where a conversation has several segments, costs between its states at both ends of each word are combined from the last
   segment to the first; what a word then costs depends on the four costs behind it, and equal words with equal
   costs behind them are solved once.
4. The rows stream past in order with the audits of their segments and are hashed as they are repaired.

The one thing a single task does for a whole conversation is step 4, since a SHA-256 has no parts; it holds a row and an audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from hourloom.sources.workspace import settle

SEGMENT_ROWS = 512
WHITE = " \t\n\x0b\x0c\r"
COST_DELETE, COST_INSERT, COST_ROLE, COST_TRUNCATED = 4, 3, 3, 3
#: Grammar ``(s?(ua)+)?``: states are nothing yet, after s, after u, after a.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
STEPS = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_A, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A}
NEXT = {START: "u", AFTER_S: "u", AFTER_U: "a", AFTER_A: "u"}
ROLES = {"u": "user", "a": "assistant"}
FOLLOWS = {"su", "ua", "au"}
FAR = 1 << 50
FINAL = (0, FAR, FAR, 0)


def damage(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with planted faults, by the CRC of conversation and turn: a drop, an empty text, no sentence ends, a repeat, another role.

    Columns are named ``conv_id``, ``turn``, ``role`` and ``text``; nulls count as one space. Repeated rows are damaged alike.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col(conv).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn).cast("string"), space))
    words = F.coalesce(F.col(text), space)
    rows = conversations.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), space).alias("role"), words.alias("text"), (F.crc32(key.cast("binary")) % 20).alias("kind"))
    rows = rows.filter("kind != 0").withColumns(
        {
            "role": F.when(F.col("kind") == 4, "user").otherwise(F.col("role")),
            "text": F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")),
            "copy": F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))),
        }
    )
    return rows.select("conv_id", "turn", "role", "text")


# --- words -------------------------------------------------------------------------

_SEGMENT = """conv {kind}, part int, seq long, word string, turn {turn}, role string, h1 long, h2 long, blank long, duplicate long,
truncated long, illegal long, head string, tail string, least {turn}, most {turn}, turns long"""


class _Segment:
    """Letters from the end of a conversation on, and what is counted along them."""

    def __init__(self, conv):
        self.conv, self.letters, self.size = conv, [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.head = self.tail = None
        self.least = self.most = self.at = None

    def add(self, n: int, letter: str, initial: str, turn, at: tuple, fault: str) -> None:
        """n equal rows, read before the ones added so far."""
        self.illegal += n - 1 + (self.head is not None and initial + self.head not in FOLLOWS)
        self.head = initial
        self.tail = initial if self.tail is None else self.tail
        if fault:
            setattr(self, fault, getattr(self, fault) + n)
        if turn is not None:
            self.turns += turn != self.least
            self.least, self.most = turn, turn if self.most is None else self.most
        self.letters.append(letter * n)
        self.size += n
        self.at = at

    def row(self, part: int, seq: int) -> tuple:
        return (
            self.conv, part, seq, "".join(self.letters), *self.at, self.blank, self.duplicate, self.truncated, self.illegal,
            self.head, self.tail, self.least, self.most, self.turns,
        )


def _runs(row: dict) -> Iterator[tuple[int, str, str]]:
    """(number, letter, fault) of the equal rows that ``row`` stands for, the last first. Letters: x goes, upper case is truncated."""
    n = row["n"]
    if row["blank"]:
        yield n, "x", "blank"
        return
    if not row["first"] or n > 1:
        yield n - row["first"], "x", "duplicate"
    if row["first"]:
        letter = row["role"][:1] if row["role"][:1] in ("s", "u", "a") else "o"
        yield 1, letter.upper() if row["truncated"] else letter, "truncated" if row["truncated"] else ""


def _segments(batches: Iterator[pa.RecordBatch], schema: pa.Schema, limit: int) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    current, out, seq = None, [], 0

    def close():
        nonlocal current, seq
        if current is not None and current.size:
            out.append(current.row(part, seq))
            seq += 1
        current = None

    for batch in batches:
        for row in batch.to_pylist():
            if current is None or current.conv != row["conv"]:
                close()
                current = _Segment(row["conv"])
            initial, at = row["role"][:1], (row["turn"], row["role"], row["h1"], row["h2"])
            for n, letter, fault in _runs(row):
                while n:
                    if current.size == limit:
                        close()
                        current = _Segment(row["conv"])
                    some = min(n, limit - current.size)
                    current.add(some, letter, initial, row["turn"], at, fault)
                    n -= some
            if len(out) >= 2000:
                yield _batch(out, schema)
                out = []
    close()
    yield _batch(out, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


# --- automaton -------------------------------------------------------------------------


@lru_cache(maxsize=1 << 16)
def solve_letter(letter: str, behind: tuple[int, ...]) -> tuple[tuple[int, ...], tuple[tuple[str, int], ...]]:
    """Cost-to-go before a row in each state, and the edits up to and with the row, with the state after it.

    ``behind`` are the costs after the row. Of equally cheap edits the one with the least letter is taken: different edits
    of a state start with different letters, so this makes the whole audit the least one.
    """
    options = []
    extra = COST_TRUNCATED if letter.isupper() else 0
    for state in range(4):
        here = [(COST_DELETE + behind[state], "D", state)]
        if letter != "x":
            kept = STEPS.get((state, letter.lower()))
            if kept is not None:
                here.append((extra + behind[kept], "K", kept))
            moved = STEPS[state, NEXT[state]]
            here.append((COST_ROLE + extra + behind[moved], "R", moved))
        options.append(here)
    return _with_inserts(options)


def solve_end(behind: tuple[int, ...]) -> tuple[tuple[int, ...], tuple[tuple[str, int], ...]]:
    """The same after the last row of a conversation, where only inserts are left."""
    return _with_inserts([[(behind[state], "", state)] for state in range(4)])


def _with_inserts(options: list[list[tuple[int, str, int]]]) -> tuple[tuple[int, ...], tuple[tuple[str, int], ...]]:
    best = [min(cost for cost, _, _ in here) for here in options]
    for _ in range(3):
        best = [min(best[s], COST_INSERT + best[STEPS[s, NEXT[s]]]) for s in range(4)]
    edits = []
    for state in range(4):
        prefix, at = "", state
        while True:
            into = STEPS[at, NEXT[at]]
            found = [(edit, target) for cost, edit, target in options[at] if cost == best[at]]
            if best[at] >= FAR or not (COST_INSERT + best[into] == best[at] and (not found or min(found)[0] > "I")):
                break
            prefix, at = prefix + "I", into
        edit, target = min(found) if found else ("", at)
        edits.append((prefix + edit, target))
    return tuple(min(b, FAR) for b in best), tuple(edits)


def _walk(words: Iterator[tuple], empty) -> Iterator[tuple[tuple, tuple, tuple, tuple]]:
    """(key, costs, audits, exits) for each sorted (key, word): nodes of the last path are shared as far as words agree.

    ``empty(key)`` gives costs, audits and exits behind the word. Costs are relative to the least one, the sum of what
    was taken off comes along as a fifth cost.
    """
    last_key, last_word, path = object(), "", []
    for key, word in words:
        if key != last_key:
            last_key, last_word, path = key, "", [empty(key)]
        same = 0
        for a, b in zip(last_word, word):  # noqa: B905  the shorter one ends it
            if a != b:
                break
            same += 1
        del path[same + 1 :]
        for letter in word[same:]:
            costs, audits, exits, off = path[-1]
            new, edits = solve_letter(letter, costs)
            low = min(new)
            path.append(
                (
                    tuple(min(c - low, FAR) if c < FAR else FAR for c in new),
                    tuple(e + audits[t] if audits[t] is not None else None for e, t in edits),
                    tuple(exits[t] for _, t in edits),
                    off + low,
                )
            )
        last_word = word
        yield key, word, path[-1]


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each word: the least cost from each state before it to each state behind it."""
    for batch in batches:
        words = batch.column(0).to_pylist()
        table = [[] for _ in words]
        for end in range(4):
            behind = tuple(0 if s == end else FAR for s in range(4))
            walked = _walk(((None, w) for w in words), lambda _, b=behind: (b, ("",) * 4, tuple(range(4)), 0))
            for i, (_, _, (costs, _, _, off)) in enumerate(walked):
                table[i].append([c + off if c < FAR else FAR for c in costs])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([[x for end in m for x in end] for m in table], pa.list_(pa.int64()))], names=["word", "matrix"])


def _boundaries(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """What lies behind each segment of a conversation, its last segment first: relative costs, or nothing for the last."""
    conv, behind = object(), None
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["conv"] != conv:
                conv, behind = row["conv"], None
            out.append((conv, row["part"], row["seq"], _key(behind)))
            base = solve_end(FINAL)[0] if behind is None else behind
            m = row["matrix"]
            costs = [min(m[4 * end + s] + base[end] for end in range(4)) for s in range(4)]
            low = min(costs)
            behind = tuple(min(c - low, FAR) for c in costs)
        yield _batch(out, schema)


def _key(behind: tuple[int, ...] | None) -> str:
    return "" if behind is None else ",".join(map(str, behind))


def _behind(key: str) -> tuple:
    """Costs, audits, exits and the sum taken off, behind a word with this key."""
    if key:
        return tuple(map(int, key.split(","))), ("",) * 4, tuple(range(4)), 0
    costs, edits = solve_end(FINAL)
    return costs, tuple(e for e, _ in edits), tuple(t for _, t in edits), 0


def _audits(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The automaton: for each (what lies behind, word) costs of the word itself, best audits and states behind, by state before it."""

    def pairs():
        for batch in batches:
            yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)

    out = []
    for key, word, (costs, audits, exits, off) in _walk(pairs(), _behind):
        base = _behind(key)[0] if key else (0,) * 4
        own = [c + off - (base[e] if key else 0) if c < FAR else FAR for c, e in zip(costs, exits, strict=True)]
        out.append((key, word, own, list(audits), list(exits)))
        if len(out) >= 500:
            yield _batch(out, schema)
            out = []
    yield _batch(out, schema)


# --- rows -------------------------------------------------------------------------------


class _Repair:
    """One conversation as its segments and rows stream past in order."""

    def __init__(self, conv):
        self.conv, self.plan, self.state, self.cost = conv, START, START, 0
        self.audit, self.pending, self.at = [], "", 0
        self.sums = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.tail = self.least = self.most = None
        self.turns = 0
        self.digest, self.begun = hashlib.sha256(), False

    def segment(self, row: dict) -> None:
        audit = row["audits"][self.plan]
        self.cost += row["costs"][self.plan]
        self.plan = row["exits"][self.plan]
        self.audit.append(audit)
        self.pending, self.at = self.pending[self.at :] + audit, 0
        for name in self.sums:
            self.sums[name] += row[name]
        if self.tail is not None:
            self.sums["illegal"] += self.tail + row["head"] not in FOLLOWS
        self.tail = row["tail"]
        if row["least"] is not None:
            self.turns += row["turns"] - (row["least"] == self.most)
            self.least, self.most = row["least"] if self.least is None else self.least, row["most"]

    def put(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) if self.begun else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.begun = True

    def inserts(self) -> None:
        while self.at < len(self.pending) and self.pending[self.at] == "I":
            role = NEXT[self.state]
            self.put(ROLES[role], "")
            self.state, self.at = STEPS[self.state, role], self.at + 1

    def row(self, role: str, text: str) -> None:
        self.inserts()
        edit, self.at = self.pending[self.at], self.at + 1
        if edit == "K":
            self.put(role, text)
            self.state = STEPS[self.state, role[:1]]
        elif edit == "R":
            new = NEXT[self.state]
            self.put(ROLES[new], text)
            self.state = STEPS[self.state, new]

    def result(self) -> tuple:
        self.inserts()
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return (self.conv, gaps, *self.sums.values(), self.cost, "".join(self.audit), self.digest.hexdigest())


def _repaired(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    current, out = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if current is None or current.conv != row["conv"]:
                if current is not None:
                    out.append(current.result())
                current = _Repair(row["conv"])
            if row["audits"] is None:
                current.row(row["role"], row["text"])
            else:
                current.segment(row)
        if len(out) >= 1000:
            yield _batch(out, schema)
            out = []
    if current is not None:
        out.append(current.result())
    yield _batch(out, schema)


def _arrow(schema: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(schema))


def _stripped(text: str) -> Column:
    return F.rtrim(F.col(text), F.lit(WHITE))


def repair(conversations: DataFrame, segment_rows: int = SEGMENT_ROWS, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    Rows stand by turn, nulls first, rows of one turn by role and then by a hash of their text; repeated rows stand together and all but
    the first are duplicates. A null role or text counts as one space; rows without a conversation form one, with a null id. Any
    first character other than s, u and a is a role that cannot be kept. An empty table has no conversation.
    Other columns are not read.
    """
    kinds = dict(conversations.dtypes)
    space = F.lit(" ")
    rows = conversations.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), space).alias("role"), F.coalesce(F.col(text), space).alias("text"))
    rows = rows.withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(1), F.reverse("text"))})

    # equal rows of one turn become one with their number; then the first turn of each role and text
    last = F.right(_stripped("text"), F.lit(1))
    flags = rows.select("conv", "turn", "role", "h1", "h2", (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("truncated"))
    same = flags.groupBy("conv", "turn", "role", "h1", "h2").agg(F.count("*").alias("n"), F.first("blank").alias("blank"), F.first("truncated").alias("truncated"))
    order = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"))
    firsts = same.groupBy("conv", "role", "h1", "h2").agg(F.min(order).alias("early"), F.count("*").alias("m")).filter("m > 1")
    firsts = firsts.select(*(F.col(c).alias(f"_{c}") for c in ("conv", "role", "h1", "h2")), "early")
    match = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))
    first = F.col("early").isNull() | ((F.col("early.known") == F.col("turn").isNotNull()) & F.col("early.turn").eqNullSafe(F.col("turn")))
    marked = same.join(firsts, match, "left").select("conv", "turn", "role", "h1", "h2", "blank", "truncated", "n", first.cast("int").alias("first"))

    backwards = [F.col("conv").asc(), F.col("turn").desc_nulls_last(), F.col("role").desc(), F.col("h1").desc(), F.col("h2").desc()]
    schema = _SEGMENT.format(kind=kinds[conv], turn=kinds[turn])
    arrow = _arrow(schema)
    segments = marked.repartitionByRange(*backwards).sortWithinPartitions(*backwards).mapInArrow(lambda x: _segments(x, arrow, segment_rows), schema)
    segments = settle(segments, "words")

    # conversations of several segments: what lies behind each
    by_conv = F.struct("part", "seq")
    several = segments.groupBy("conv").agg(F.count("*").alias("m")).filter("m > 1").select(F.col("conv").alias("_conv"))
    long = segments.join(several, F.col("conv").eqNullSafe(F.col("_conv")), "left_semi").select("conv", "part", "seq", "word")
    words = long.select("word").distinct()
    matrices = words.repartitionByRange("word").sortWithinPartitions("word").mapInArrow(_matrices, "word string, matrix array<long>")
    chain = f"conv {kinds[conv]}, part int, seq long, behind string"
    chain_arrow = _arrow(chain)
    ends = long.join(matrices, "word").repartition("conv").sortWithinPartitions("conv", by_conv).select("conv", "part", "seq", "matrix")
    ends = ends.mapInArrow(lambda x: _boundaries(x, chain_arrow), chain)
    known = segments.alias("s").join(ends.alias("e"), F.expr("s.conv <=> e.conv and s.part = e.part and s.seq = e.seq"), "left").select("s.*", F.coalesce("behind", F.lit("")).alias("behind"))
    known = settle(known, "segments")

    solved = "behind string, word string, costs array<long>, audits array<string>, exits array<int>"
    solved_arrow = _arrow(solved)
    nodes = known.select("behind", "word").distinct().repartitionByRange("behind", "word").sortWithinPartitions("behind", "word")
    nodes = nodes.mapInArrow(lambda x: _audits(x, solved_arrow), solved)
    heads = known.join(nodes, ["behind", "word"])

    # rows and the audits of their segments, in the order of the conversation
    counts = ["blank", "duplicate", "truncated", "illegal", "head", "tail", "least", "most", "turns", "costs", "audits", "exits"]
    place = (-F.col("part").cast("long") * (1 << 32) - F.col("seq")).alias("place")
    heads = heads.select("conv", "turn", "role", "h1", "h2", place, F.lit(None).cast("string").alias("text"), *counts)
    types = dict(heads.dtypes)
    plain = rows.select("conv", "turn", "role", "h1", "h2", F.lit(1).cast("long").alias("place"), "text", *(F.lit(None).cast(types[c]).alias(c) for c in counts))
    stream = heads.unionByName(plain).repartition("conv")
    stream = stream.sortWithinPartitions(F.col("conv").asc(), F.col("turn").asc_nulls_first(), "role", "h1", "h2", "place").drop("turn", "h1", "h2", "place")
    result = f"conv_id {kinds[conv]}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    result_arrow = _arrow(result)
    return stream.mapInArrow(lambda x: _repaired(x, result_arrow), result)


def repair_all(original: DataFrame, damaged: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """``repair(damaged)`` with a row for every conversation of ``original``; those without rows have zeros and an empty text."""
    ids = original.select(F.col("conv_id").alias("_conv")).distinct()
    out = repair(damaged, segment_rows)
    joined = ids.join(out, F.col("_conv").eqNullSafe(F.col("conv_id")), "left").drop("conv_id").withColumnRenamed("_conv", "conv_id")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return joined.fillna(0, numbers).fillna({"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}).select(*out.columns)
