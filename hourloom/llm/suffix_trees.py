"""Removal of repeated word windows by suffix trees over prefix-partitioned suffixes.

A window of ``width`` words is the prefix, down to that depth, of the suffix that starts there. Two windows are equal if and
only if their suffixes meet in one node at depth ``width``, so trees are built top-down to it and no further.

1. Suffixes are partitioned by a prefix of variable length. The short one is the least-hashed run of ``anchor`` words
   of the window: equal windows have the same, neighbours mostly share it, so their suffixes travel as one chunk of text. An
   anchor that one document alone has cannot lead to a repeat; only hashes of anchors travel to find that out.
2. Where more than ``heavy`` documents have an anchor, its prefix is lengthened to the whole window: such suffixes go
   one by one, and equal ones fall together before and after the shuffle.
3. A task takes the groups of its prefixes in bundles of ``bundle_bytes``. Each bundle becomes a forest, grown a word a level:
   the suffixes of a node are split by their next word, compared as text, and a suffix that is alone in its node is a leaf. Nodes
   left at depth ``width`` are the repeats; a node knows the least id of its documents.
4. Windows with a smaller id's twin go back to their documents, which leave out the words they cover.

The text itself is shuffled once, by document; groups, occurrences and spans are rows that Spark aggregates and joins.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.llm.textbytes import TextSlice, mixed, owners, text_slices
from hourloom.sources.workspace import settle

_U = np.uint64
_NO_ID = (1 << 63) - 1
_WORD_BASE = 0xD6E8FEB86659FD93


@dataclass(frozen=True)
class WindowSpec:
    """``width``: words of a repeated window; ``anchor``: of its short prefix; ``heavy``: documents beyond which that is lengthened."""

    width: int = 13
    anchor: int = 5
    heavy: int = 20_000
    bundle_bytes: int = 4 << 20


# --- words and runs ------------------------------------------------------------------


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0] ... begin[0] + size[0] - 1, begin[1] ..."""
    total = np.cumsum(size)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(begin - (total - size), size)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _U(_WORD_BASE)), np.full(n, _U(pow(_WORD_BASE, -1, 1 << 64)))
    up[:1] = down[:1] = 1
    return np.cumprod(up), np.cumprod(down)


class _Words:
    """The words of a slice joined by single spaces: where they stand, and hashes of runs of them."""

    def __init__(self, s: TextSlice):
        white = s.white()
        begins, ends = s.word_ranges(white)
        sizes = ends - begins
        n = len(begins)
        self.edges = np.searchsorted(begins, s.edges)
        self.data = np.full(int(sizes.sum()) + n, 0x20, np.uint8)
        self.data[np.arange(len(self.data) - n) + np.repeat(np.arange(n), sizes)] = s.data[~white]
        self.begin = np.cumsum(sizes) - sizes + np.arange(n)
        self.end = self.begin + sizes
        self.sums = s.prefix_codes(self.data)

    def __len__(self) -> int:
        return len(self.begin)

    def hashes(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Of the text from each first to each last word."""
        return TextSlice.range_hashes(self.sums, self.begin[first], self.end[last])

    def pair_keys(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two independent hashes: over bytes, and over whole words."""
        at = np.arange(len(self))
        up, down = _powers(len(self) + 1)
        sums = np.concatenate([[_U(0)], np.cumsum(mixed(self.hashes(at, at) ^ _U(0xA5A5)) * up[:-1])])
        return self.hashes(first, last), mixed((sums[last + 1] - sums[first]) * down[first])


def _least_anchor(words: _Words, spec: WindowSpec) -> tuple[np.ndarray, np.ndarray]:
    """Start of every window and the least hash of the anchors in it."""
    n = len(words) - spec.width + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    at = np.arange(len(words) - spec.anchor + 1)
    least = words.hashes(at, at + spec.anchor - 1)
    wide, reach = 1, spec.width - spec.anchor + 1
    while wide * 2 <= reach:
        least = np.minimum(least[:-wide], least[wide:])
        wide *= 2
    shift = reach - wide
    least = np.minimum(least[: len(least) - shift], least[shift:]) if shift else least
    ends = np.repeat(words.edges[1:], np.diff(words.edges))
    starts = np.flatnonzero(np.arange(n) + spec.width <= ends[:n])
    return starts, least[starts]


def _runs(words: _Words, spec: WindowSpec) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring windows with one anchor: first window, number, anchor, document."""
    starts, key = _least_anchor(words, spec)
    doc = owners(words.edges)[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (key[1:] != key[:-1]) | (starts[1:] != starts[:-1] + 1) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    return starts[first], np.diff(np.append(first, len(starts))), key[first], doc[first]


def _anchors(batches: Iterator[pa.RecordBatch], spec: WindowSpec) -> Iterator[pa.RecordBatch]:
    """The different anchors of each document."""
    for batch in batches:
        for s in text_slices(batch.column(2)):
            _, _, key, doc = _runs(_Words(s), spec)
            order = np.lexsort((key, doc))
            key, doc = key[order], doc[order]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
            row = pa.array(doc[new] + s.first)
            yield pa.RecordBatch.from_arrays([pa.array(key[new].view(np.int64)), batch.column(0).take(row), batch.column(1).take(row)], names=["key", "id", "hash"])


def _flat(column: pa.Array, first: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Values of the lists of some rows, and the row of each."""
    part = column.slice(first, size)
    lengths = np.diff(part.offsets.to_numpy())
    return part.flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.repeat(np.arange(size), lengths)


def _has(key: np.ndarray, doc: np.ndarray, listed: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which (document, key) are listed."""
    names, at = np.unique(np.concatenate([key, listed]), return_inverse=True)
    code = at + np.concatenate([doc, of]) * len(names)
    return np.isin(code[: len(key)], code[len(key) :])


def _chunks(batch: pa.RecordBatch, spec: WindowSpec) -> Iterator[tuple]:
    """The chunks of each slice of ``(id, hash, text, keys, heavy)`` rows: words, first word, windows, group, row of the batch."""
    for s in text_slices(batch.column(2)):
        words = _Words(s)
        start, count, key, doc = _runs(words, spec)
        marked = _has(key, doc, *_flat(batch.column(3), s.first, len(s)))
        long = marked & _has(key, doc, *_flat(batch.column(4), s.first, len(s)))
        whole = marked & ~long
        single = _ranges(start[long], count[long])
        own = words.hashes(single, single + spec.width - 1) if len(single) else np.empty(0, np.uint64)
        first = np.concatenate([start[whole], single])
        windows = np.concatenate([count[whole], np.ones(len(single), np.int64)])
        group = np.concatenate([key[whole], mixed(own ^ _U(0x1F))])
        of = np.concatenate([doc[whole], np.repeat(doc[long], count[long])])
        if len(first):
            yield words, first, windows, group, of + s.first, words.edges[of]


_GROUPED = "gkey long, k1 long, k2 long, chunk binary, least long, most long"


def _group_rows(batches: Iterator[pa.RecordBatch], spec: WindowSpec) -> Iterator[pa.RecordBatch]:
    """Chunks by group, equal ones of a batch only once, with the least and largest id that has them."""
    for batch in batches:
        parts, ids = [], batch.column(0).to_numpy()
        for words, first, windows, group, row, _ in _chunks(batch, spec):
            last = first + windows + spec.width - 2
            k1, k2 = words.pair_keys(first, last)
            begin, size = words.begin[first], words.end[last] - words.begin[first]
            keep = _firsts(k1, k2)
            text = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(keep), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(size[keep])]).astype(np.int64)), pa.py_buffer(words.data[_ranges(begin[keep], size[keep])])])
            order = np.lexsort((k2, k1))
            edge = np.flatnonzero(_new(k1[order], k2[order]))
            back = np.lexsort((k2[keep], k1[keep]))
            least, most = np.empty(len(keep), np.int64), np.empty(len(keep), np.int64)
            least[back] = np.minimum.reduceat(ids[row][order], edge)
            most[back] = np.maximum.reduceat(ids[row][order], edge)
            parts.append(_table(group[keep], k1[keep], k2[keep], text, least, most))
        if parts:
            yield _distinct(pa.concat_tables(parts)).to_batches()[0]


def _table(gkey, k1, k2, chunk, least, most) -> pa.Table:
    as_long = lambda x: pa.array(x.view(np.int64) if x.dtype == np.uint64 else x)
    return pa.table({"gkey": as_long(gkey), "k1": as_long(k1), "k2": as_long(k2), "chunk": chunk.cast(pa.binary()), "least": as_long(least), "most": as_long(most)})


def _new(*keys: np.ndarray) -> np.ndarray:
    """Where sorted keys change."""
    out = np.ones(len(keys[0]), bool)
    out[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return out


def _firsts(k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
    """One row of each pair of keys."""
    order = np.lexsort((k2, k1))
    return np.sort(order[_new(k1[order], k2[order])])


def _distinct(table: pa.Table) -> pa.Table:
    """Rows sorted by group and key, equal ones merged."""
    table = table.combine_chunks()
    if not table.num_rows:
        return table
    keys = [table.column(c).to_numpy() for c in ("gkey", "k1", "k2")]
    order = np.lexsort(keys[::-1])
    edge = np.flatnonzero(_new(*(k[order] for k in keys)))
    out = table.take(pa.array(order[edge]))
    least = np.minimum.reduceat(table.column("least").to_numpy()[order], edge)
    most = np.maximum.reduceat(table.column("most").to_numpy()[order], edge)
    return out.drop_columns(["least", "most"]).append_column("least", pa.array(least)).append_column("most", pa.array(most)).combine_chunks()


# --- trees ------------------------------------------------------------------------------


def deep_nodes(word: np.ndarray, start: np.ndarray, root: np.ndarray, least: np.ndarray, depth: int) -> np.ndarray:
    """For each suffix the least id below its node at ``depth``; ``word`` are word numbers, ``root`` the tree of each suffix.

    Trees grow a level at a time: children of a node are told apart by their next word. A suffix alone in its node is
    a leaf with its own least id and takes no further part.
    """
    out = least.copy()
    alive, node = np.arange(len(start)), root
    wide = int(word.max()) + 1 if len(word) else 1
    for level in range(depth + 1):
        if level:
            node = node * wide + word[start[alive] + level - 1]
        _, node, size = np.unique(node, return_inverse=True, return_counts=True)
        inner = size[node] > 1
        alive, node = alive[inner], node[inner]
    if len(alive):
        _, node = np.unique(node, return_inverse=True)
        found = np.full(node.max() + 1, _NO_ID)
        np.minimum.at(found, node, least[alive])
        out[alive] = found[node]
    return out


def _repeats(table: pa.Table, spec: WindowSpec) -> pa.RecordBatch:
    """Runs of windows of whole groups that a smaller id has as well: ``k1, k2, first, windows, least``."""
    table = _distinct(table)
    text = table.column("chunk").cast(pa.large_binary()).combine_chunks()
    s = next(text_slices(text, limit=1 << 62))
    begins, ends = s.word_ranges(s.white())
    sizes = ends - begins
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    spelled = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(s.data[~s.white()])])
    word = spelled.dictionary_encode().indices.to_numpy().astype(np.int64)
    edges = np.searchsorted(begins, s.edges)
    windows = np.diff(edges) - spec.width + 1
    start, chunk = _ranges(edges[:-1], windows), np.repeat(np.arange(len(windows)), windows)
    _, root = np.unique(table.column("gkey").to_numpy(), return_inverse=True)
    low = deep_nodes(word, start, root[chunk], table.column("least").to_numpy()[chunk], spec.width)
    hit = low < table.column("most").to_numpy()[chunk]
    start, chunk, low = start[hit], chunk[hit], low[hit]
    new = np.ones(len(start), bool)
    new[1:] = (chunk[1:] != chunk[:-1]) | (low[1:] != low[:-1]) | (start[1:] != start[:-1] + 1)
    head = np.flatnonzero(new)
    of = pa.array(chunk[head])
    columns = [table.column("k1").take(of), table.column("k2").take(of), pa.array(start[head] - edges[chunk[head]]), pa.array(np.diff(np.append(head, len(start)))), pa.array(low[head])]
    return pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns], names=["k1", "k2", "first", "windows", "least"])


def _trees(batches: Iterator[pa.RecordBatch], spec: WindowSpec) -> Iterator[pa.RecordBatch]:
    """Whole groups of the sorted rows in bundles."""
    held, size = None, 0
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        size += rows.nbytes
        if size < spec.bundle_bytes:
            continue
        group = held.column("gkey").to_numpy()
        cut = int(np.searchsorted(group, group[-1]))
        if cut:
            yield _repeats(held.slice(0, cut), spec)
        held = _distinct(held.slice(cut))  # the last group goes on; equal chunks of it are merged
        size = held.nbytes
    if held is not None and held.num_rows:
        yield _repeats(held, spec)


# --- documents --------------------------------------------------------------------------


def _occurrences(batches: Iterator[pa.RecordBatch], spec: WindowSpec) -> Iterator[pa.RecordBatch]:
    """Where each document has which chunk: ``k1, k2, id, hash, start`` in words."""
    for batch in batches:
        for words, first, windows, _, row, origin in _chunks(batch, spec):
            k1, k2 = words.pair_keys(first, first + windows + spec.width - 2)
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), batch.column(0).take(at), batch.column(1).take(at), pa.array((first - origin).astype(np.int64))],
                names=["k1", "k2", "id", "hash", "start"],
            )


def _cut(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    """``c0, c1, ...`` as given, then the measures of the words that ``spans`` leaves; the last column of the input are the spans."""
    for batch in batches:
        texts, spans = batch.column(0), batch.column(batch.num_columns - 1)
        rest = batch.columns[1:-1]
        for s in text_slices(texts):
            words = _Words(s)
            step = np.zeros(len(words) + 1, np.int64)
            part = spans.slice(s.first, len(s))
            if part.null_count < len(part):
                pairs = part.flatten()
                of = np.repeat(np.arange(len(s)), np.diff(part.offsets.to_numpy()))
                np.add.at(step, words.edges[of] + pairs.field(0).to_numpy(), 1)
                np.add.at(step, words.edges[of] + pairs.field(1).to_numpy(), -1)
            gone = np.cumsum(step)[:-1] > 0
            kept = np.repeat(~gone, words.end - words.begin + 1)
            data = words.data[kept]
            total = np.concatenate([[0], np.cumsum(np.where(gone, 0, words.end - words.begin + 1))])[words.edges]
            left = [data[total[i] : max(total[i], total[i + 1] - 1)].tobytes() for i in range(len(s))]
            removed = np.concatenate([[0], np.cumsum(gone)])[words.edges]
            columns = [c.slice(s.first, len(s)) for c in rest]
            columns += [pa.array(np.diff(words.edges)), pa.array(np.diff(removed)), pa.array([hashlib.sha256(x).hexdigest() for x in left])]
            names = [*(f"r{i}" for i in range(len(rest))), "n_words", "n_removed", "kept_sha256"]
            if with_text:
                columns.append(pa.array([x.decode("utf-8") for x in left], pa.string()))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(columns, names=names)


def _spans(texts: DataFrame, spec: WindowSpec) -> DataFrame:
    """``(id, hash, spans)``: for each text its runs of words that a smaller id has as well, as (first, after the last)."""
    found = texts.mapInArrow(lambda x: _anchors(x, spec), "key long, id long, hash long").repartition("key")
    shared = found.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    marks = found.join(shared, "key").groupBy("id", "hash").agg(F.collect_set("key").alias("keys"), F.collect_set(F.when(F.col("n") > spec.heavy, F.col("key"))).alias("heavy"))
    marks = settle(marks, "anchors")

    marked = texts.join(marks, ["id", "hash"]).select("id", "hash", "text", "keys", "heavy")
    groups = marked.mapInArrow(lambda x: _group_rows(x, spec), _GROUPED)
    sorted_groups = groups.repartition("gkey").sortWithinPartitions("gkey", "k1", "k2")
    repeats = sorted_groups.mapInArrow(lambda x: _trees(x, spec), "k1 long, k2 long, first long, windows long, least long")
    places = marked.mapInArrow(lambda x: _occurrences(x, spec), "k1 long, k2 long, id long, hash long, start long")
    hits = places.join(repeats, ["k1", "k2"]).filter("least < id")
    begin = F.col("start") + F.col("first")
    return hits.groupBy("id", "hash").agg(F.collect_set(F.struct(begin.alias("a"), (begin + F.col("windows") + (spec.width - 1)).alias("b"))).alias("spans"))


def _with_keys(docs: DataFrame, id_column: str, text: str) -> tuple[DataFrame, list]:
    key = [F.coalesce(F.col(id_column).cast("long"), F.lit(_NO_ID)).alias("id"), F.xxhash64(text).alias("hash")]
    return docs.select(*key, F.col(text).alias("text")), key


def repeated_windows(docs: DataFrame, spec: WindowSpec | None = None, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id_column, n_words, n_removed, kept_sha256)`` for every row of ``docs``.

    A word goes if a window of ``width`` words over it also stands in a row with a smaller id. Words are runs without ASCII white space,
    compared as they are. Rows that share an id do not remove each other's words, repeated rows get the same answer, a null id is
    larger than all others, null and empty texts have no words, an empty table has no rows. Other columns are not read.
    """
    spec = spec or WindowSpec()
    texts, _ = _with_keys(docs, id_column, text)
    ready = texts.join(_spans(texts, spec), ["id", "hash"], "left").select("text", "id", "spans")
    out = ready.mapInArrow(lambda x: _cut(x, False), "r0 long, n_words long, n_removed long, kept_sha256 string")
    return out.select(F.when(F.col("r0") != _NO_ID, F.col("r0")).alias(id_column), "n_words", "n_removed", "kept_sha256")


def remove_windows(docs: DataFrame, spec: WindowSpec | None = None, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows of ``docs`` with the same columns, their text the kept words joined by single spaces; a null text becomes empty."""
    spec = spec or WindowSpec()
    texts, key = _with_keys(docs, id_column, text)
    spans = _spans(texts, spec)
    rest = [c for c in docs.columns if c != text]
    rows = docs.select(*key, F.col(text).alias("text"), *(F.col(c).alias(f"r{i}") for i, c in enumerate(rest)))
    ready = rows.join(spans, ["id", "hash"], "left").select("text", *(f"r{i}" for i in range(len(rest))), "spans")
    types = dict(docs.dtypes)
    schema = ", ".join([*(f"r{i} {types[c]}" for i, c in enumerate(rest)), "n_words long, n_removed long, kept_sha256 string, kept_text string"])
    out = ready.mapInArrow(lambda x: _cut(x, True), schema)
    source = {c: f"r{i}" for i, c in enumerate(rest)} | {text: "kept_text"}
    return out.select(*(F.col(source[c]).alias(c) for c in docs.columns))
