"""License scans by template markup: optional and replaceable regions compiled into token automata.

Templates are written in the markup of license matching guidelines: plain words are mandatory,
``<<beginOptional>> ... <<endOptional>>`` may be left out, ``<<var;name=...;match=.{a,b}>>`` stands for a to b words of any
kind. A template is found where its automaton accepts a run of a text's words: the mandatory wording must
match word for word. All states of an automaton advance together, so a scan is linear in the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.llm.textbytes import text_slices

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_MARK = re.compile(r"<<(beginOptional|endOptional|var)[^>]*?(?:match=\.\{(\d+),(\d+)\})?>>")


def words_of(text: bytes) -> list[bytes]:
    """Words of the lower-cased (A-Z) text: runs of digits, letters and everything beyond ASCII."""
    return _WORD.findall(text.lower())


@dataclass(frozen=True)
class Template:
    """``base`` marks phrases that are counted at all their places."""

    label: str
    markup: str
    base: bool = False


@dataclass
class Automaton:
    """Items in a row: a word, or a gap of ``(least, most)`` words. ``skips`` leads from a region's begin to its end."""

    label: str
    base: bool
    items: list = field(default_factory=list)
    skips: dict[int, list[int]] = field(default_factory=dict)
    mandatory: int = 0

    def closure(self, states: set[tuple[int, int]]) -> set[tuple[int, int]]:
        """States reachable without a word. A state is (item, words of its gap taken so far)."""
        todo, out = list(states), set(states)
        while todo:
            at, taken = todo.pop()
            more = [(to, 0) for to in self.skips.get(at, ()) if taken == 0]
            if at < len(self.items) and isinstance(self.items[at], tuple) and taken >= self.items[at][0]:
                more.append((at + 1, 0))
            for state in more:
                if state not in out:
                    out.add(state)
                    todo.append(state)
        return out

    def first_words(self) -> set[bytes]:
        found = [self.items[at] for at, _ in self.closure({(0, 0)}) if at < len(self.items)]
        if any(isinstance(x, tuple) for x in found):
            raise ValueError(f"the template of {self.label} begins with a replaceable region")
        return set(found)

    def match(self, words: Sequence[bytes], begin: int) -> int | None:
        """The end of the shortest accepted run that starts at ``begin``."""
        states, end = self.closure({(0, 0)}), len(self.items)
        for i in range(begin, len(words)):
            step = set()
            for at, taken in states:
                item = self.items[at]
                if isinstance(item, tuple):
                    if taken < item[1]:
                        step.add((at, taken + 1))
                elif item == words[i]:
                    step.add((at + 1, 0))
            if not step:
                return None
            states = self.closure(step)
            if any(at == end for at, _ in states):
                return i + 1
        return None


def compile_template(template: Template) -> Automaton:
    out, begins, at = Automaton(template.label, template.base), [], 0

    def plain(text: str) -> None:
        found = words_of(text.encode())
        out.items += found
        out.mandatory += 0 if begins else len(found)

    for mark in _MARK.finditer(template.markup):
        plain(template.markup[at : mark.start()])
        if mark[1] == "beginOptional":
            begins.append(len(out.items))
        elif mark[1] == "endOptional":
            out.skips.setdefault(begins.pop(), []).append(len(out.items))
        else:
            out.items.append((int(mark[2] or 0), int(mark[3] or 20)))
        at = mark.end()
    plain(template.markup[at:])
    if begins or not out.mandatory:
        raise ValueError(f"the template of {template.label} leaves a region open or has no mandatory word")
    return out


# Phrases counted for every text, and the mandatory wording of public licenses and notices.
PHRASES = (
    Template("mit", "mit license", base=True),
    Template("apache", "apache license", base=True),
    Template("gpl", "general public license", base=True),
)
NOTICES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of <<var;name=work;match=.{1,8}>> to deal in the software without restriction"),
    Template("mit", "<<beginOptional>>released<<endOptional>><<beginOptional>>licensed<<endOptional>><<beginOptional>>distributed<<endOptional>> under <<beginOptional>>the terms of<<endOptional>> the <<beginOptional>>expat<<endOptional>> mit license"),
    Template("apache", "licensed under the apache license version 2 0 <<beginOptional>>the license you may not use this file except in compliance with the license<<endOptional>>"),
    Template("gpl", "gnu general public license <<beginOptional>>as published by the free software foundation either<<endOptional>> version <<var;name=version;match=.{1,2}>>"),
    Template("gpl", "licensed under <<beginOptional>>the<<endOptional>> <<beginOptional>>gnu<<endOptional>> gpl <<beginOptional>>version<<endOptional>> <<var;name=version;match=.{0,1}>>"),
    Template("lgpl", "gnu <<var;name=kind;match=.{0,1}>> lesser general public license"),
    Template("agpl", "gnu affero general public license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("bsd", "licensed under the <<var;name=kind;match=.{0,3}>> bsd <<var;name=clauses;match=.{0,2}>> license"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Template("mpl", "subject to the terms of the mozilla public license <<beginOptional>>v<<endOptional>> <<var;name=version;match=.{0,3}>>"),
    Template("unlicense", "free and unencumbered software released into the public domain"),
    Template("cc-by", "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>> cc by <<var;name=version;match=.{1,1}>> 0"),
    Template("cc-by", "creative commons attribution <<var;name=version;match=.{0,3}>> <<beginOptional>>international<<endOptional>> license"),
    Template("cc-by-sa", "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>> cc by sa"),
    Template("cc-by-sa", "creative commons attribution sharealike"),
    Template("cc-by-nc", "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>> cc by nc"),
    Template("cc-by-nc", "creative commons attribution noncommercial"),
    Template("cc0", "creative commons zero"),
    Template("all-rights-reserved", "copyright <<beginOptional>>c<<endOptional>> <<var;name=holder;match=.{0,12}>> all rights reserved"),
)


@dataclass(frozen=True)
class Span:
    label: str
    begin: int
    end: int
    mandatory: int
    base: bool


class Scanner:
    """All templates at once; automata start only where one of their first words stands."""

    def __init__(self, templates: Sequence[Template]):
        self.by_first: dict[bytes, list[Automaton]] = {}
        for automaton in map(compile_template, templates):
            for word in automaton.first_words():
                self.by_first.setdefault(word, []).append(automaton)
        self.first = frozenset(self.by_first)

    def spans(self, words: Sequence[bytes]) -> list[Span]:
        if self.first.isdisjoint(words):
            return []
        out = []
        for i, word in enumerate(words):
            for automaton in self.by_first.get(word, ()):
                end = automaton.match(words, i)
                if end is not None:
                    out.append(Span(automaton.label, i, end, automaton.mandatory, automaton.base))
        return out


_SPAN = "array<struct<label: string, first_word: long, end_word: long, base: boolean>>"
RESULT = f"n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans {_SPAN}"


def scan(docs: DataFrame, templates: Sequence[Template] = PHRASES + NOTICES, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id_column, n_words, n_base, first_word, last_word, base_labels, labels, score, spans)`` for every row of ``docs``.

    ``spans`` are all accepted runs as word numbers. ``score`` is m / (m + 2) for the m mandatory words of the longest
    wording found, 0 without one. Null and empty texts have no words. One pass, no shuffle.
    """
    templates = tuple(templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for batch in batches:
            for s in text_slices(batch.column(1)):
                rows = []
                for i in range(len(s)):
                    words = words_of(s.text(i))
                    spans = scanner.spans(words)
                    base = [x for x in spans if x.base]
                    most = max((x.mandatory for x in spans), default=0)
                    rows.append(
                        {
                            "n_words": len(words), "n_base": len(base), "first_word": min((x.begin for x in base), default=None), "last_word": max((x.begin for x in base), default=None),
                            "base_labels": ",".join(sorted({x.label for x in base})), "labels": ",".join(sorted({x.label for x in spans})), "score": most / (most + 2),
                            "spans": [{"label": x.label, "first_word": x.begin, "end_word": x.end, "base": x.base} for x in spans],
                        }
                    )
                found = pa.RecordBatch.from_pylist(rows, _schema())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(s.first, len(s)), *found.columns], names=["id", *found.schema.names])

    kind = dict(docs.dtypes)[id_column]
    return docs.select(F.col(id_column).alias("id"), F.col(text).alias("t")).mapInArrow(run, f"id {kind}, {RESULT}").withColumnRenamed("id", id_column)


def _schema() -> pa.Schema:
    span = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("base", pa.bool_())])
    numbers = [(x, pa.int64()) for x in ("n_words", "n_base", "first_word", "last_word")]
    return pa.schema([*numbers, ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.list_(span))])
