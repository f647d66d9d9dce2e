"""Token files: ORC with run-length coded ids, row indexes and Bloom filters on the document id.

Texts are ordered by id through one range partitioning, encoded in Arrow batches and written by Spark's ORC
writer, so ids of a document form one list value, integer columns get ORC's run-length encoding, and a
reader that asks for some documents skips files by footer, stripes by statistics and Bloom filter, and
rows by index. Reading is parallel by stripe.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import repeat
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourloom.llm.textbytes import _LOWER, TextSlice, text_slices
from hourloom.sources.workspace import settle


@dataclass(frozen=True)
class TokenSpec:
    """``end_id`` closes each document. ``cached_words`` bounds what a worker remembers of words it has encoded."""

    end_id: int = 1
    cached_words: int = 400_000
    stripe_bytes: int = 64 << 20
    index_stride: int = 1000
    compression: str = "zstd"


# How the tokenizer that words can be encoded one by one for prepares and cuts a text, as its file says.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": _PIECES}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
# The ASCII part of that pattern, for lower-cased text.
_ASCII_PIECES = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\x09-\x0d\x20a-z0-9]+")
_CLOSING = b".,;:!?*#$%&|"
# What the tokenizer's preparation leaves as it is, besides ASCII pieces.
_PREPARED = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
# Kinds of ASCII bytes in that pattern.
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
_KINDS = np.full(256, _OTHER, np.uint8)
_KINDS[[0x20, *range(0x09, 0x0E)]] = _SPACE
_KINDS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_KINDS[0x30:0x3A] = _DIGIT
_TAILS = ((b"s",), (b"t",), (b"r", b"e"), (b"v", b"e"), (b"m",), (b"l", b"l"), (b"d",))


def goes_by_words(model: dict) -> bool:
    """Whether words between ASCII white space may be encoded one by one: the file prepares and cuts texts as above, and its special tokens begin with ``<|``."""
    marked = all(t["content"].startswith("<|") and not (t["lstrip"] or t["rstrip"] or t["normalized"] or t["single_word"]) for t in model.get("added_tokens") or [])
    kind = model["model"]
    whole = kind.get("type") == "BPE" and kind.get("end_of_word_suffix") == "</w>" and not kind.get("dropout")
    plain = model.get("post_processor") is None and model.get("truncation") is None and model.get("padding") is None
    return marked and whole and plain and model.get("normalizer") == _NORMALIZER and model.get("pre_tokenizer") == _PRE_TOKENIZER


def _cut(word: bytes) -> list[bytes]:
    if b"<|" in word:
        return [word]
    if word.isascii():
        return _ASCII_PIECES.findall(word.lower())
    core = word.rstrip(_CLOSING)
    if core != word and core and core.decode()[-1].lower().isalpha():
        return [core, word[len(core) :]]
    return [word]


def units_of(s: TextSlice) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """What the texts of a slice are encoded by, and the edges of the documents among it.

    Words between ASCII white space, which the tokenizer drops and never joins across, are lower-cased and cut where its own
    pattern cuts them, if they consist of ASCII and the letters from U+00C0 to U+00FF. Others stay as they are, also those that
    may hold a special token; what a unit is can be told from its bytes.
    """
    data, n = s.data, len(s.data)
    edge = np.zeros(n + 1, bool)
    edge[s.edges] = True
    kind, low = _KINDS[data], _LOWER[data]
    odd = np.zeros(n, bool)
    if n and data.max() > 0x7F:
        second = np.zeros(n, bool)
        second[1:] = data[:-1] == 0xC3
        letter = second & (data > 0x7F) & (data < 0xC0) & (data & 0xDF != 0x97)  # not the signs of multiplication and division
        low[letter & (data < 0x9F)] += 0x20
        first = np.append(letter[1:], False)
        kind[letter | first] = _LETTER
        odd = (data > 0x7F) & ~letter & ~first
    mark = np.flatnonzero(data[:-1] == 0x3C)
    odd[mark[data[mark + 1] == 0x7C]] = True
    solid = kind != _SPACE
    begin = solid.copy()
    begin[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT) | edge[1:-1]
    quote = np.flatnonzero(data == 0x27)
    quote = quote[begin[quote]]
    for tail in _TAILS:
        at = quote[quote + len(tail) < n]
        for k, letter in enumerate(tail, 1):
            at = at[(low[at + k] == letter[0]) & ~edge[at + k]]
        after = at + len(tail) + 1
        begin[at + 1] = False
        after = after[after < n]
        begin[after[kind[after] == _LETTER]] = True
    if odd.any():
        word = solid.copy()
        word[1:] &= ~solid[:-1] | edge[1:-1]
        first = np.flatnonzero(word)
        last = np.flatnonzero(solid & np.append(~solid[1:] | edge[1:-1], True)) + 1
        whole = np.unique(np.searchsorted(first, np.flatnonzero(odd), side="right") - 1)
        inside = np.zeros(n + 1, np.int8)
        inside[first[whole]] += 1
        inside[last[whole]] -= 1
        inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
        low = np.where(inside, data, low)
        begin = np.where(inside, word, begin)
    starts = np.flatnonzero(begin)
    offsets = np.append(np.flatnonzero(begin[solid]), np.count_nonzero(solid)).astype(np.int64)
    units = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(low[solid])])
    return units, np.searchsorted(starts, s.edges)


class _Encoder:
    """Ids of texts by the units of ``units_of``, each encoded once while it is remembered; texts of any other tokenizer go to the library whole."""

    _loaded: dict[int, _Encoder] = {}

    def __init__(self, model: str, limit: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.limit = Tokenizer.from_str(model), limit
        self.by_words = goes_by_words(json.loads(model))
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        # The same model for pieces that are prepared and cut already.
        self.merger = Tokenizer.from_str(model)
        if self.by_words:
            self.merger.normalizer = None
            self.merger.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self._forget()

    @classmethod
    def of(cls, model: str, limit: int) -> _Encoder:
        key = zlib.crc32(model.encode())
        if key not in cls._loaded:
            cls._loaded[key] = cls(model, limit)
        return cls._loaded[key]

    def _forget(self) -> None:
        self.rows: dict[bytes, int] = {}  # the place of a unit in the two arrays
        self.edges, self.ids = np.zeros(1, np.int64), np.empty(0, np.int32)

    def _remember(self, units: list[bytes], sizes: np.ndarray, ids: np.ndarray) -> None:
        self.rows.update(zip(units, range(len(self.edges) - 1, len(self.edges) - 1 + len(units)), strict=True))
        self.edges = np.concatenate([self.edges, self.edges[-1] + np.cumsum(sizes, dtype=np.int64)])
        self.ids = np.concatenate([self.ids, ids])

    def _places(self, units: Sequence[bytes]) -> np.ndarray:
        """Where units are remembered; -1 for others."""
        return np.fromiter(map(self.rows.get, units, repeat(-1)), np.int64, len(units))

    def _spread(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of remembered units one after the other, and the number of each."""
        sizes = self.edges[places + 1] - self.edges[places]
        return self.ids[np.repeat(self.edges[places] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())], sizes

    def _learn_together(self, tokenizer, pieces: list[bytes], at_once: int = 20_000) -> None:
        """Encode pieces that the tokenizer keeps whole, many in one text; the ids that close a word tell them apart.

        Where a piece turns out to be more than one word, none of its text is remembered.
        """
        for i in range(0, len(pieces), at_once):
            part = pieces[i : i + at_once]
            ids = np.array(tokenizer.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)[0].ids, np.int32)
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) == len(part) and len(ids) == ends[-1]:
                self._remember(part, np.diff(ends, prepend=0), ids)

    def _learn(self, units: list[bytes]) -> None:
        self._learn_together(self.merger, [u for u in units if _PREPARED.fullmatch(u)])
        cut = {u: _cut(u) for u in units if u not in self.rows}
        pieces = [p for p in dict.fromkeys(p for c in cut.values() for p in c) if p not in self.rows]
        prepared = [p for p in pieces if (p.isascii() and b"<|" not in p) or _PREPARED.fullmatch(p)]
        self._learn_together(self.merger, prepared)
        self._learn_together(self.tokenizer, [p for p in set(pieces).difference(prepared) if p.decode().isalpha()])
        rest = [p for p in pieces if p not in self.rows]
        if rest:
            found = [x.ids for x in self.tokenizer.encode_batch_fast([p.decode() for p in rest], add_special_tokens=False)]
            self._remember(rest, np.array([len(x) for x in found]), np.array([i for x in found for i in x], np.int32))
        words = [u for u in cut if u not in self.rows]
        if words:
            ids, sizes = self._spread(self._places([p for w in words for p in cut[w]]))
            counts = np.array([len(cut[w]) for w in words])
            self._remember(words, np.add.reduceat(sizes, np.cumsum(counts) - counts), ids)

    def __call__(self, s: TextSlice) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a slice one after the other, and the number of each text."""
        if not self.by_words:
            found = [x.ids for x in self.tokenizer.encode_batch_fast([s.text(i).decode() for i in range(len(s))], add_special_tokens=False)]
            return np.array([i for x in found for i in x], np.int32), np.array([len(x) for x in found], np.int64)
        if len(self.rows) > self.limit:
            self._forget()
        units, edges = units_of(s)
        coded = units.dictionary_encode()
        different = coded.dictionary.to_numpy(zero_copy_only=False)
        places = self._places(different)
        new = np.flatnonzero(places < 0)
        self._learn(different[new].tolist())
        places[new] = self._places(different[new])
        ids, sizes = self._spread(places[coded.indices.to_numpy()])
        total = np.concatenate([[0], np.cumsum(sizes)])
        return ids, np.diff(total[edges])


def encode(docs: DataFrame, model: str, spec: TokenSpec, id_column: str, text: str) -> DataFrame:
    """``(id_column, ids)`` row by row; ``model`` is the tokenizer's own JSON."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one tokenizer file, some megabytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _Encoder.of(shared.value, spec.cached_words)
        for batch in batches:
            for s in text_slices(batch.column(1)):
                found, sizes = encoder(s)
                edges = np.concatenate([[0], np.cumsum(sizes + 1)])
                ends = np.zeros(edges[-1], bool)
                ends[edges[1:] - 1] = True
                closed = np.full(edges[-1], spec.end_id, np.int32)
                closed[~ends] = found
                ids = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(closed))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(s.first, len(s)), ids], names=["id", "ids"])

    kind = dict(docs.dtypes)[id_column]
    out = docs.select(F.col(id_column).alias("id"), F.col(text).alias("t")).mapInArrow(run, f"id {kind}, ids array<int>")
    return out.withColumnRenamed("id", id_column)


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, spec: TokenSpec | None = None, id_column: str = "doc_id", text: str = "text") -> None:
    """Write the ids of every row in ascending order of ``id_column`` (nulls first) to ORC files under ``path``.

    Null and empty texts have the end id alone. Rows that share an id are ordered by a hash of their text.
    """
    spec = spec or TokenSpec()
    tie = F.xxhash64(F.col(text))
    ordered = docs.select(F.col(id_column), F.col(text), tie.alias("_tie")).repartitionByRange(F.col(id_column), F.col("_tie")).sortWithinPartitions(id_column, "_tie")
    tokens = encode(ordered, Path(tokenizer_path).read_text(), spec, id_column, text)
    options = {"orc.bloom.filter.columns": id_column, "orc.bloom.filter.fpp": "0.01", "orc.row.index.stride": str(spec.index_stride), "orc.stripe.size": str(spec.stripe_bytes), "orc.create.index": "true"}
    tokens.write.options(**options).option("compression", spec.compression).orc(path)


def read_tokens(spark: SparkSession, path: str, ids: Sequence[int] | None = None, id_column: str = "doc_id") -> DataFrame:
    """The written documents, or those with the given ids: the filter reaches the files' statistics and Bloom filters."""
    tokens = spark.read.orc(path)
    return tokens if ids is None else tokens.filter(F.col(id_column).isin(list(ids)))


def checksums(tokens: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``(id_column, n_tokens, ids_crc32)`` of written documents; the checksum is over little-endian unsigned 32-bit ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            edges = lists.offsets.to_numpy()
            raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), dtype="<u4")).cast("B")
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(edges).astype(np.int64)), pa.array(crc, pa.int64())], names=["id", "n_tokens", "ids_crc32"])

    kind = dict(tokens.dtypes)[id_column]
    return tokens.select(F.col(id_column).alias("id"), "ids").mapInArrow(run, f"id {kind}, n_tokens long, ids_crc32 long").withColumnRenamed("id", id_column)


def with_running_start(rows: DataFrame, value: str, name: str, order: Sequence[str]) -> DataFrame:
    """Adds the sum of ``value`` over all rows before, in the given order.

    Sums run inside stretches of 1024 neighbours, then over the stretches of a partition of the sort, then over
    its partitions, so no window holds more than a part of the table.
    """
    at = settle(rows.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part, stretch = F.shiftright("_at", 33), F.shiftright("_at", 10)
    before = lambda c, w: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    stretches = at.groupBy(part.alias("_part"), stretch.alias("_of")).agg(F.sum(value).alias("_sum"))
    parts = stretches.groupBy("_part").agg(F.sum("_sum").alias("_sum"))
    parts = parts.select("_part", before("_sum", Window.orderBy("_part")).alias("_base"))  # a row per partition
    offsets = stretches.withColumn("_inside", before("_sum", Window.partitionBy("_part").orderBy("_of"))).join(parts, "_part")
    offsets = offsets.select("_of", (F.col("_inside") + F.col("_base")).alias("_begin"))
    inside: Column = before(value, Window.partitionBy("_of").orderBy("_at"))
    return at.withColumn("_of", stretch).withColumn("_inside", inside).join(offsets, "_of").withColumn(name, (F.col("_begin") + F.col("_inside")).cast("long")).drop("_at", "_of", "_inside", "_begin")


def token_report(tokens: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``(id_column, start, n_tokens, ids_crc32)``; ``start`` counts the ids of all documents before a document."""
    rows = settle(checksums(tokens, id_column), "checksums")  # the sort samples its rows first, and files should be read once
    return with_running_start(rows, "n_tokens", "start", [id_column, "ids_crc32", "n_tokens"])
