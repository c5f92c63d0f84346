"""Mention scan: one pass over every text with a keyword automaton.

A pattern names the keywords that its matches begin with. One automaton of all keywords runs over a
text and says where a match can start; the pattern is tried there and nowhere else, and never inside
its last match, so the matches are those of a search from left to right. Work grows with the text and
its keywords, however many matches it holds. Patterns without keywords are searched in the whole text.

Patterns are regular expressions with the inline flags ``i`` and ``U`` at their beginning: without ``U``
the classes ``\\d \\s \\w`` and letter case are those of ASCII, while ``\\b`` always knows all letters.
Offsets are 0-based code points.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

#: matches handed over at a time
ROWS = 4096


@dataclass(frozen=True)
class Pattern:
    """One row of a pattern table: scheme, regular expression, a cue the text must hold, keywords that matches begin with."""

    scheme: str
    regex: str
    cue: str | None = None
    starts: tuple[str, ...] = ()


@lru_cache(maxsize=256)
def compiled(pattern: str) -> re.Pattern:
    flags = re.match(r"\(\?([iU]+)\)", pattern)
    body, given = (pattern[flags.end():], flags[1]) if flags else (pattern, "")
    case = re.IGNORECASE if "i" in given else 0
    if "U" in given:
        return re.compile(body, case)
    return re.compile(re.sub(r"((?<!\\)(?:\\\\)*)\\b", r"\1(?u:\\b)", body), case | re.ASCII)


class Scanner:
    """All matches of a pattern table in a text."""

    def __init__(self, patterns: Sequence[Pattern]):
        self.patterns = patterns
        self.cues = [p.cue and compiled(p.cue) for p in patterns]
        self.tests = [compiled(p.regex) for p in patterns]
        words: dict[str, list[int]] = {}
        for number, p in enumerate(patterns):
            for word in p.starts:
                words.setdefault(word.lower(), []).append(number)
        self.automaton = ahocorasick.Automaton()
        for word, numbers in words.items():
            self.automaton.add_word(word, (len(word), numbers))
        if words:
            self.automaton.make_automaton()

    def __call__(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(pattern, start, end) of every match, pattern by pattern."""
        open_ = [not cue or cue.search(text) is not None for cue in self.cues]
        low = text.lower()
        aligned = len(low) == len(text)  # lower-casing a few letters changes the length
        found: list[list[tuple[int, int, int]]] = [[] for _ in self.patterns]
        done = [0] * len(self.patterns)
        places: list[list[int]] = [[] for _ in self.patterns]
        if aligned and len(self.automaton):
            for end, (size, numbers) in self.automaton.iter(low):
                for n in numbers:
                    if open_[n]:
                        places[n].append(end - size + 1)
        for n, test in enumerate(self.tests):
            if not open_[n]:
                continue
            if not aligned or not self.patterns[n].starts:
                found[n] = [(n, *m.span()) for m in test.finditer(text) if m.end() > m.start()]
                continue
            for at in sorted(set(places[n])):  # keywords of several lengths end in another order than they start
                if at >= done[n] and (m := test.match(text, at)) and m.end() > at:
                    found[n].append((n, at, m.end()))
                    done[n] = m.end()
        for rows in found:
            yield from rows


def scan_mentions(texts: DataFrame, keys: Sequence[str], fields: Sequence[str], patterns: Sequence[Pattern], context: int = 60) -> DataFrame:
    """Rows (keys, scheme, text_field, raw_text, char_start, char_end, context): every match in the given text columns, with so many characters around it."""
    keys, fields, patterns = list(keys), list(fields), tuple(patterns)
    rows = texts.select(*keys, *[f for f in fields if f not in keys])
    kinds = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)
    schema = f"{kinds}, scheme string, text_field string, raw_text string, char_start int, char_end int, context string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(patterns)

        def made(batch: pa.RecordBatch, hits: list) -> pa.RecordBatch:
            row, *rest = zip(*hits)
            taken = [batch.column(batch.schema.get_field_index(k)).take(pa.array(row)) for k in keys]
            kinds = (pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string())
            return pa.RecordBatch.from_arrays(
                taken + [pa.array(values, kind) for values, kind in zip(rest, kinds)],
                [*keys, "scheme", "text_field", "raw_text", "char_start", "char_end", "context"])

        for batch in batches:
            hits: list = []
            for field in fields:
                column = batch.column(batch.schema.get_field_index(field))
                for i in range(batch.num_rows):
                    text = column[i].as_py()
                    if not text:
                        continue
                    for n, start, end in scanner(text):
                        hits.append((i, patterns[n].scheme, field, text[start:end], start, end, text[max(0, start - context):end + context]))
                        if len(hits) == ROWS:
                            yield made(batch, hits)
                            hits = []
            if hits:
                yield made(batch, hits)

    return rows.mapInArrow(run, schema)
