"""Removal of repeated passages by a distributed, prefix-bounded suffix sort over a difference cover.

Only equality of ``length``-byte prefixes counts, so the sort is spread and bounded by it:

1. Every window of ``length`` bytes is keyed by the least hash of the short substrings in it. Equal windows
   have equal keys, and neighbouring windows mostly share one, so runs of windows travel as one chunk of text.
2. Keys seen once in the corpus cannot repeat; only 4-byte prints and one bit per key travel to find that out.
3. Chunks of repeated keys are spread by key, equal chunks of a block going only once. Where one key has
   several different chunks, their suffixes are sorted with the difference cover {1, 2} modulo 3: sampled
   positions get names from sorted triples of 8-byte characters, names of names until they span the prefix,
   the other positions are sorted by (byte, name) and merged in, and neighbours with equal prefixes form
   classes. A class knows the least id of its documents.
4. A key with very many chunks is spread window by window instead, so no key fills a task.
5. Each block learns the least ids of its windows and removes what a smaller id has.

Documents are handled in blocks of about two megabytes, written once as compressed Arrow batches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.llm.textbytes import TextSlice, mixed, text_slices
from hourloom.sources.workspace import settle

_U = np.uint64
_LAST = (1 << 63) - 1
BLOCK_BYTES = 1 << 21
_ZSTD = pa.Codec("zstd")
_CHUNK = (np.int32, np.uint64, np.uint64, np.int64, np.int64, np.int64, np.uint8)  # index, key, chunk, least, most, size; all texts
_ANSWER = (np.int32, np.int64, np.int64, np.int64)  # index, from, windows, least


@dataclass(frozen=True)
class RepeatSpec:
    """``length``: bytes of a repeated string; ``print_bytes``: of the substrings that key windows. ``heavy``: chunks of one key that a task takes together."""

    length: int = 50
    print_bytes: int = 20
    bucket_bytes: int = 2 << 20
    least_buckets: int = 64
    heavy: int = 20_000
    sort_bytes: int = 1 << 20


# --- suffix sort -----------------------------------------------------------------


def _names(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense ranks, from 1, of rows of keys, of which the first counts most, and an order of the rows by them. Several keys are ranks or zero."""
    key = keys[0]
    for more in keys[1:]:
        wide, bits = int(more.max(initial=0)).bit_length(), int(key.max(initial=0)).bit_length()
        if wide + bits > 63:
            key = _names(key)[0]
        key = (key << wide) | more
    order = np.argsort(key)
    key = key[order]
    new = np.ones(len(order), np.int64)
    new[1:] = key[1:] != key[:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new)
    return rank, order


def packed(text: np.ndarray, reach: int) -> np.ndarray:
    """At each position the next 8 bytes as one big-endian number, zeros beyond the end; ``reach`` more positions."""
    padded = np.concatenate([text, np.zeros(reach + 8, np.uint8)])
    return np.lib.stride_tricks.sliding_window_view(padded, 8)[: len(text) + reach].copy().view(">u8").ravel().astype(np.uint64)


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``text`` in the order of their suffixes; suffixes equal in ``depth`` bytes stand together."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    chars, _ = _names(packed(text, 24))
    sampled = np.flatnonzero(np.arange(n) % 3 != 0)
    span, names = 24, np.zeros(n + 1, np.int64)
    names[sampled], order = _names(chars[sampled], chars[sampled + 8], chars[sampled + 16])
    while span < depth and names.max() < len(sampled):
        far, farther = np.minimum(sampled + span, n), np.minimum(sampled + 2 * span, n)
        names[sampled], order = _names(names[sampled], names[far], names[farther])
        span *= 3
    order = sampled[order]
    rest = np.arange(0, n, 3)
    ends = np.concatenate([text.astype(np.int64), np.zeros(2, np.int64)])
    names = np.append(names, 0)
    one = lambda p: (ends[p] << 40) | names[p + 1]  # noqa: E731  against positions 1 modulo 3
    two = lambda p: (ends[p] << 48) | (ends[p + 1] << 40) | names[np.minimum(p + 2, n)]  # noqa: E731  against 2 modulo 3
    rest = rest[np.argsort(one(rest))]
    first, second = order[order % 3 == 1], order[order % 3 == 2]
    at = np.arange(len(rest)) + np.searchsorted(one(first), one(rest)) + np.searchsorted(two(second), two(rest))
    at = np.maximum.accumulate(at - np.arange(len(rest))) + np.arange(len(rest))
    out = np.empty(n, np.int64)
    taken = np.zeros(n, bool)
    taken[at] = True
    out[at] = rest
    out[~taken] = order
    return out


def window_classes(text: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """A class for each start; two starts have one class if and only if their ``length`` bytes are equal."""
    order = suffix_order(text, length)
    wanted = np.zeros(len(text), bool)
    wanted[starts] = True
    order = order[wanted[order]]
    chars = packed(text, 8)
    differs = np.zeros(len(order), bool)
    for step in [*range(0, length - 7, 8), length - 8]:
        value = chars[order + step]
        differs[1:] |= value[1:] != value[:-1]
    classes = np.empty(len(text), np.int64)
    classes[order] = np.cumsum(differs)
    return classes[starts]


# --- blocks ------------------------------------------------------------------------


def _pack(columns: dict[str, pa.Array]) -> bytes:
    batch = pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns.values()], names=list(columns))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack(body: bytes) -> pa.Table:
    return pa.ipc.open_stream(body).read_all().combine_chunks()


def _frame(*arrays: np.ndarray, squeeze: bool = False) -> bytes:
    """Arrays one after the other behind their sizes: what a block sends to a bucket is small, and there are many of them."""
    raw = np.array([x.nbytes for x in arrays], np.int64).tobytes() + b"".join([x.tobytes() for x in arrays])
    return len(raw).to_bytes(8, "little") + _ZSTD.compress(raw, asbytes=True) if squeeze else raw


def _unframe(body: bytes, *types: type, squeezed: bool = False) -> list[np.ndarray]:
    raw = memoryview(_ZSTD.decompress(body[8:], int.from_bytes(body[:8], "little"), asbytes=True) if squeezed else body)
    ends = 8 * len(types) + np.cumsum([0, *np.frombuffer(raw, np.int64, len(types)).tolist()])
    return [np.frombuffer(raw[a:b], kind) for a, b, kind in zip(ends[:-1], ends[1:], types, strict=True)]


def _together(bodies: list[bytes], *types: type, squeezed: bool = False) -> tuple[list[np.ndarray], np.ndarray]:
    """The arrays of all frames, each joined, and the number of rows of each frame."""
    parts = [_unframe(x, *types, squeezed=squeezed) for x in bodies]
    return [np.concatenate(x) for x in zip(*parts, strict=True)], np.array([len(x[0]) for x in parts], np.int64)


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    context = TaskContext.get()
    block = (context.partitionId() if context else 0) << 32
    for batch in batches:
        for s in text_slices(batch.column(0), BLOCK_BYTES):
            rows = batch.slice(s.first, len(s))
            body = _pack(dict(zip(rows.schema.names, rows.columns, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([len(s.data)]), pa.array([body], pa.binary())], names=["block", "raw", "body"])
            block += 1


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0] ... begin[0] + size[0] - 1, begin[1] ..."""
    out = np.repeat(begin - (np.cumsum(size) - size), size)
    out += np.arange(len(out))
    return out


class _Runs:
    """Runs of neighbouring windows of a block with one key."""

    def __init__(self, s: TextSlice, spec: RepeatSpec):
        self.sums = s.prefix_codes(s.data)
        least = self.least_prints(s, spec)
        windows = np.maximum(np.diff(s.edges) - spec.length + 1, 0)
        begin, end = s.edges[:-1][windows > 0], (s.edges[:-1] + windows)[windows > 0]
        new = np.ones(len(least) + 1, bool)  # runs of windows, and of places where none begins
        np.not_equal(least[1:], least[:-1], out=new[1:-1])
        step = np.zeros(len(least) + 1, np.int8)
        step[begin] += 1
        step[end] -= 1
        inside = np.cumsum(step, dtype=np.int8).view(bool)
        new[:-1] &= inside[:-1]
        new[begin] = new[end] = True
        first = np.flatnonzero(new)
        used = inside[first]
        self.count = np.diff(first, append=first[-1:])[used]
        self.start = first[used]
        self.key = mixed(least[self.start])
        self.chunk = self.print_of(s, self.start, self.start + self.count + spec.length - 1, self.key)

    def least_prints(self, s: TextSlice, spec: RepeatSpec, tile: int = 1 << 15) -> np.ndarray:
        """The least hash of the short substrings of each window, some windows at a time, whose arrays stay near the processor."""
        k, reach = spec.print_bytes, spec.length - spec.print_bytes + 1  # substrings in a window
        out = np.empty(max(len(s.data) - spec.length + 1, 0), np.uint64)
        for at in range(0, len(out), tile):
            to = min(at + tile, len(out))
            least = s.spread_hashes(self.sums, k, at, to + reach - 1)
            wide = 1
            while wide * 2 <= reach:
                least = np.minimum(least[:-wide], least[wide:])
                wide *= 2
            shift = reach - wide
            np.minimum(least[: len(least) - shift], least[shift:], out=out[at:to])
        return out

    def print_of(self, s: TextSlice, begin: np.ndarray, end: np.ndarray, key: np.ndarray) -> np.ndarray:
        return mixed(s.range_hashes(self.sums, begin, end) + key * _U(3) + (end - begin).astype(np.uint64))


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    return (((key >> _U(32)) * _U(buckets)) >> _U(32)).astype(np.int64)


def _cuts(bucket: np.ndarray) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of a sorted array."""
    if not len(bucket):
        return []
    at = np.flatnonzero(np.diff(bucket)) + 1
    begin = np.concatenate([[0], at])
    return list(zip(bucket[begin].tolist(), begin.tolist(), np.append(at, len(bucket)).tolist(), strict=True))


def _only_slice(table: pa.Table) -> TextSlice:
    return next(text_slices(table.column("c0"), limit=1 << 62))


def _key_rows(batches: Iterator[pa.RecordBatch], spec: RepeatSpec, buckets: int) -> Iterator[pa.RecordBatch]:
    """For each block and bucket: short prints of its distinct keys, with the number of different chunks."""
    for batch in batches:
        for block, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            runs = _Runs(_only_slice(_unpack(body)), spec)
            keys, of, n = np.unique(runs.key, return_inverse=True, return_counts=True)
            again = np.flatnonzero(n[of] > 1)  # only there a key can have several chunks
            _, one = np.unique(runs.chunk[again], return_index=True)
            chunks = np.bincount(of[again[one]], minlength=len(keys))
            many = np.minimum(np.maximum(chunks, np.minimum(n, 2)), 65535).astype(np.uint16)
            prints, parts = keys.astype(np.uint32), _cuts(_bucket(keys, buckets))
            bodies = [_frame(prints[a:b], many[a:b]) for _, a, b in parts]
            yield pa.RecordBatch.from_arrays([pa.array([block] * len(parts), pa.int64()), pa.array([x[0] for x in parts], pa.int64()), pa.array(bodies, pa.binary())], names=["block", "bucket", "body"])


def _key_marks(table: pa.Table, spec: RepeatSpec) -> pa.Table:
    """For each block: 0 for keys seen once, 1 for repeated ones, 2 for those with too many chunks for a task."""
    (prints, many), rows = _together(table.column("body").to_pylist(), np.uint32, np.uint16)
    _, at = np.unique(prints, return_inverse=True)
    total = np.bincount(at, weights=many)[at]
    marks = ((total > 1).astype(np.uint8) + (total > spec.heavy)).astype(np.uint8)
    edges = np.concatenate([[0], np.cumsum(rows)])
    bodies = [marks[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "body": pa.array(bodies, pa.binary())})


class _Chunks:
    """The chunks of a block that may repeat: where they stand, and the different ones among them."""

    def __init__(self, s: TextSlice, marks: list, spec: RepeatSpec):
        runs = _Runs(s, spec)
        keys, of = np.unique(runs.key, return_inverse=True)
        mark = np.frombuffer(b"".join([x["body"] for x in sorted(marks, key=lambda x: x["bucket"])]) if marks else b"", np.uint8)
        mark = mark[of] if len(keys) else mark[:0]
        whole, single = mark == 1, mark == 2
        at = _ranges(runs.start[single], runs.count[single])
        window = s.range_hashes(runs.sums, at, at + spec.length)
        self.start = np.concatenate([runs.start[whole], at])
        self.count = np.concatenate([runs.count[whole], np.ones(len(at), np.int64)])
        self.key = np.concatenate([runs.key[whole], mixed(window)])
        self.chunk = np.concatenate([runs.chunk[whole], window])
        _, self.first, self.index = np.unique(self.chunk, return_index=True, return_inverse=True)


def _chunk_rows(batches: Iterator[pa.RecordBatch], spec: RepeatSpec, buckets: int) -> Iterator[pa.RecordBatch]:
    """The different chunks of a block that go to each bucket, with the least and largest id that has them."""
    names = ["block", "bucket", "body"]
    for batch in batches:
        for block, body, marks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            table = _unpack(body)
            s = _only_slice(table)
            c = _Chunks(s, marks, spec)
            if not len(c.start):
                continue
            doc = _ids(table)[np.searchsorted(s.edges, c.start, side="right") - 1]
            by_chunk = np.argsort(c.index, kind="stable")
            edge = np.searchsorted(c.index[by_chunk], np.arange(len(c.first)))
            least, most = np.minimum.reduceat(doc[by_chunk], edge), np.maximum.reduceat(doc[by_chunk], edge)
            by_key = np.argsort(c.key[c.first], kind="stable")
            out = []
            for bucket, a, b in _cuts(_bucket(c.key[c.first][by_key], buckets)):
                use = by_key[a:b]
                begin, size = c.start[c.first[use]], c.count[c.first[use]] + spec.length - 1
                text = s.data[_ranges(begin, size)]
                out.append((block, bucket, _frame(use.astype(np.int32), c.key[c.first[use]], c.chunk[c.first[use]], least[use], most[use], size.astype(np.int64), text, squeeze=True)))
            blocks, at_bucket, bodies = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(at_bucket, pa.int64()), pa.array(bodies, pa.binary())], names=names)


def _least_ids(table: pa.Table, spec: RepeatSpec) -> pa.Table:
    """For each block that sent chunks: runs of windows with the least id that has them, where a smaller one than its largest."""
    (index, key, chunk, least, most, length, data), sent = _together(table.column("body").to_pylist(), *_CHUNK, squeezed=True)
    owner = np.repeat(np.arange(len(sent)), sent)
    _, first, entry = np.unique(chunk, return_index=True, return_inverse=True)
    low = np.full(len(first), _LAST)
    np.minimum.at(low, entry, least)
    edges = np.concatenate([[0], np.cumsum(length)])
    begin, size = edges[first], edges[first + 1] - edges[first]
    # entries whose key stands for several chunks are sorted, some keys at a time
    by_key = np.argsort(key[first], kind="stable")
    _, group, n = np.unique(key[first][by_key], return_inverse=True, return_counts=True)
    runs = []
    alone = by_key[n[group] == 1]
    runs.append((alone, np.zeros(len(alone), np.int64), size[alone] - spec.length + 1, low[alone]))
    shared, of = by_key[n[group] > 1], group[n[group] > 1]
    at = 0
    while at < len(shared):
        reach = np.cumsum(size[shared[at:]])
        to = at + max(1, int(np.searchsorted(reach, spec.sort_bytes, side="right")))
        to = int(np.searchsorted(of, of[to - 1], side="right"))  # a key's chunks stay together
        use = shared[at:to]
        piece = data[_ranges(begin[use], size[use])]
        offset = np.cumsum(size[use]) - size[use]
        windows = size[use] - spec.length + 1
        starts = _ranges(offset, windows)
        entry_of = np.repeat(np.arange(len(use)), windows)
        classes = window_classes(piece, starts, spec.length)
        found = np.full(classes.max() + 1, _LAST)
        np.minimum.at(found, classes, low[use][entry_of])
        value = found[classes]
        new = np.ones(len(starts), bool)
        new[1:] = (value[1:] != value[:-1]) | (entry_of[1:] != entry_of[:-1])
        head = np.flatnonzero(new)
        runs.append((use[entry_of[head]], starts[head] - offset[entry_of[head]], np.diff(np.append(head, len(starts))), value[head]))
        at = to
    of_entry, from_window, windows, value = (np.concatenate(x) for x in zip(*runs, strict=True))
    order = np.argsort(of_entry, kind="stable")
    edge = np.searchsorted(of_entry[order], np.arange(len(first) + 1))
    per_row = np.diff(edge)[entry]
    pick = order[_ranges(edge[entry], per_row)]
    row = np.repeat(np.arange(len(entry)), per_row)
    smaller = value[pick] < most[row]
    pick, row = pick[smaller], row[smaller]
    cuts = _cuts(owner[row])
    blocks = table.column("block").to_pylist()
    bodies = [_frame(index[row[a:b]], from_window[pick[a:b]], windows[pick[a:b]], value[pick[a:b]], squeeze=True) for _, a, b in cuts]
    return pa.table({"block": pa.array([blocks[x[0]] for x in cuts], pa.int64()), "body": pa.array(bodies, pa.binary())})


def _ids(table: pa.Table) -> np.ndarray:
    return table.column("c1").combine_chunks().fill_null(_LAST).to_numpy()


def _covered(table: pa.Table, marks: list | None, answers: list | None, spec: RepeatSpec) -> tuple[TextSlice, np.ndarray]:
    s = _only_slice(table)
    step = np.zeros(len(s.data) + 1, np.int64)
    if answers:
        c = _Chunks(s, marks, spec)
        start, index = c.start, c.index
        (at, begin, windows, least), _ = _together([x["body"] for x in answers], *_ANSWER, squeezed=True)
        order = np.argsort(at, kind="stable")
        lo, hi = np.searchsorted(at[order], index), np.searchsorted(at[order], index, side="right")
        pick, place = order[_ranges(lo, hi - lo)], np.repeat(np.arange(len(index)), hi - lo)
        doc = _ids(table)[np.searchsorted(s.edges, start[place], side="right") - 1]
        use = least[pick] < doc
        a = start[place[use]] + begin[pick[use]]
        np.add.at(step, a, 1)
        np.add.at(step, a + windows[pick[use]] + spec.length - 1, -1)
    return s, np.cumsum(step)[:-1] > 0


MEASURES = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _cleaned(docs: DataFrame, spec: RepeatSpec, keep: list[str], id_column: str, text: str) -> DataFrame:
    """c1 (the id), the columns ``keep`` as c2, c3, ..., then the measures; the column ``text`` among ``keep`` is cleaned."""
    types = dict(docs.dtypes)
    source = docs.select(F.col(text).alias("c0"), F.col(id_column).cast("long").alias("c1"), *(F.col(c).alias(f"c{i + 2}") for i, c in enumerate(keep) if c != text))
    blocks = settle(source.mapInArrow(_block_rows, "block long, raw long, body binary"), "blocks")
    total = blocks.agg(F.sum("raw")).first()[0] or 0
    buckets = max(spec.least_buckets, -(-total // spec.bucket_bytes))
    blocks = blocks.select("block", "body")
    keys = blocks.mapInArrow(lambda x: _key_rows(x, spec, buckets), "block long, bucket long, body binary")
    marks = keys.groupBy("bucket").applyInArrow(lambda t: _key_marks(t, spec), "block long, bucket long, body binary")
    marks = settle(marks.groupBy("block").agg(F.collect_list(F.struct("bucket", "body")).alias("marks")), "marks")
    marked = blocks.join(marks, "block", "left")
    chunks = marked.mapInArrow(lambda x: _chunk_rows(x, spec, buckets), "block long, bucket long, body binary")
    answers = chunks.groupBy("bucket").applyInArrow(lambda t: _least_ids(t, spec), "block long, body binary")
    answers = answers.groupBy("block").agg(F.collect_list(F.struct("body")).alias("answers"))
    names = ["c1", *(f"c{i + 2}" for i in range(len(keep)))]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body, where, found in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                table = _unpack(body)
                s, gone = _covered(table, where, found, spec)
                n, removed, spans, digest, left = [], [], [], [], []
                for i in range(len(s)):
                    a, b = s.edges[i], s.edges[i + 1]
                    g = gone[a:b]
                    kept = s.data[a:b][~g].tobytes()
                    n.append(b - a)
                    removed.append(int(g.sum()))
                    spans.append(int((g[1:] & ~g[:-1]).sum() + g[:1].sum()))
                    digest.append(hashlib.sha256(kept).hexdigest())
                    if text in keep:
                        left.append(kept.decode("utf-8", "ignore"))
                columns = [pa.array(left, pa.string()) if f"c{i + 2}" not in table.column_names else table.column(f"c{i + 2}").combine_chunks() for i in range(len(keep))]
                measures = [pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest, pa.string())]
                yield pa.RecordBatch.from_arrays([table.column("c1").combine_chunks(), *columns, *measures], names=[*names, *(x.split()[0] for x in MEASURES.split(", "))])

    ready = marked.join(answers, "block", "left").select("body", "marks", "answers")
    return ready.mapInArrow(cut, ", ".join(["c1 long", *(f"c{i + 2} {types[c]}" for i, c in enumerate(keep)), MEASURES]))


def repeated_spans(docs: DataFrame, spec: RepeatSpec | None = None, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id_column, n_bytes, n_removed, n_spans, kept_sha256)`` for every row of ``docs``.

    A byte goes if a ``length``-byte string over it also starts in a row with a smaller id. Rows that share an id
    do not remove each other; a null id is larger than all others; null and empty texts have nothing to
    remove. Other columns are not read.
    """
    return _cleaned(docs, spec or RepeatSpec(), [], id_column, text).withColumnRenamed("c1", id_column)


def remove_repeats(docs: DataFrame, spec: RepeatSpec | None = None, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows of ``docs`` with the same columns, their text without repeated passages.

    Bytes of characters that were cut through are left out; a null text becomes empty.
    """
    out = _cleaned(docs, spec or RepeatSpec(), docs.columns, id_column, text)
    return out.select(*(F.col(f"c{i + 2}").alias(c) for i, c in enumerate(docs.columns)))
