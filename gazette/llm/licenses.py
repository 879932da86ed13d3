"""License scans by template-markup matching.

A template is wording with ``[[optional]]`` and ``{{name:least-most}}``
(replaceable, that many words) regions.  It compiles into a word automaton
that accepts exactly the texts whose mandatory words stand in order; it runs
from every place where the template's opening words stand.  Fixed phrases give
the base labels.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.llm.common import bounded_batches, byte_list, name_of, slices
from gazette.llm.shingles import word_blocks

# FIXED VALUES: base phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# FIXED VALUES: what the BSD licences share, with the place of the third clause.
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
      that the following conditions are met: [[1.]] Redistributions of source code must retain the above copyright
      notice, this list of conditions and the following disclaimer. [[2.]] Redistributions in binary form must
      reproduce the above copyright notice, this list of conditions and the following disclaimer in the
      documentation and/or other materials provided with the distribution. CLAUSE This software is provided by
      {{holder:1-12}} "as is" and any express or implied warranties, including, but not limited to, the implied
      warranties of merchantability and fitness for a particular purpose are disclaimed. In no event shall
      {{holder:1-12}} be liable for any direct, indirect, incidental, special, exemplary, or consequential damages
      (including, but not limited to, procurement of substitute goods or services; loss of use, data, or profits;
      or business interruption) however caused and on any theory of liability, whether in contract, strict
      liability, or tort (including negligence or otherwise) arising in any way out of the use of this software,
      even if advised of the possibility of such damage."""

# FIXED VALUES: whole templates, disclaimers included; the wording of the licences is public.
TEMPLATES = {
    "mit-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this
      software and associated documentation files [[(the "Software")]], to deal in the Software without
      restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute,
      sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished
      to do so, subject to the following conditions: The above copyright notice and this permission notice
      [[(including the next paragraph)]] shall be included in all copies or substantial portions of the Software.
      The Software is provided "as is", without warranty of any kind, express or implied, including but not
      limited to the warranties of merchantability, fitness for a particular purpose and noninfringement. In no
      event shall {{holder:1-12}} be liable for any claim, damages or other liability, whether in an action of
      contract, tort or otherwise, arising from, out of or in connection with the Software or the use or other
      dealings in the Software.""",
    "isc-text": """Permission to use, copy, modify, and[[/or]] distribute this software for any purpose with or
      without fee is hereby granted, provided that the above copyright notice and this permission notice appear
      in all copies. The software is provided "as is" and {{holder:1-12}} disclaims all warranties with regard to
      this software including all implied warranties of merchantability and fitness. In no event shall
      {{holder:1-12}} be liable for any special, direct, indirect, or consequential damages or any damages
      whatsoever resulting from loss of use, data or profits, whether in an action of contract, negligence or
      other tortious action, arising out of or in connection with the use or performance of this software.""",
    "bsd-2-text": _BSD.replace("CLAUSE", ""),
    "bsd-3-text": _BSD.replace(
        "CLAUSE",
        """[[3.]] Neither the name of {{holder:1-12}} nor the names of [[its]] contributors may be used to endorse
      or promote products derived from this software without specific prior written permission.""",
    ),
    "apache-2-notice": "Licensed under the Apache License[[,]] Version 2[[.0]]",
    "mit-notice": "Released under the [[terms of the]] MIT License",
    "cc-by-nc-notice": "Licensed under [[a]] [[the]] [[Creative Commons]] CC BY NC [[SA]] [[4.0]]",
    "gpl-notice": """This {{work:1-4}} is licensed under the [[terms of the]] GNU General Public License
      [[as published by the Free Software Foundation]] version {{number:1-1}}""",
}

#: All bytes that are not a-z, 0-9 or beyond ASCII (after lower-casing A-Z) part words.
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_REGION = re.compile(r"\[\[(.*?)\]\]|\{\{\w+:(\d+)-(\d+)\}\}", re.S)


def normal_form(data: bytes) -> bytes:
    """Words of a whole text, each between single spaces; empty without words."""
    parts = [b" ".join(words) for words in word_blocks(data.translate(_WORDS))]
    joined = b" ".join(p for p in parts if p)
    return b" " + joined + b" " if joined else b""


def _words(wording: str) -> list[bytes]:
    return wording.encode().translate(_WORDS).split()


@dataclass(frozen=True)
class Automaton:
    """States 0..n; ``steps[s]`` reads a word (None: any) to reach s + 1, and
    ``skips[s]`` are states reached from s without reading."""

    opening: bytes
    steps: tuple[bytes | None, ...]
    skips: tuple[frozenset[int], ...]

    def _settle(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for to in self.skips[todo.pop()]:
                if to not in states:
                    states.add(to)
                    todo.append(to)
        return states

    def accept(self, words: Iterator[bytes]) -> int:
        """Words of the shortest accepted prefix, 0 if none is accepted."""
        states, end = self._settle({0}), len(self.steps)
        for read, word in enumerate(words, 1):
            states = self._settle({s + 1 for s in states if s < end and self.steps[s] in (None, word)})
            if end in states:
                return read
            if not states:
                break
        return 0


def compile_template(markup: str) -> Automaton:
    steps: list[bytes | None] = []
    jumps: list[tuple[int, int]] = []
    opening: list[bytes] = []
    at, plain = 0, True

    def literal(wording: str) -> None:
        steps.extend(_words(wording))
        if plain:
            opening.extend(_words(wording))

    for region in _REGION.finditer(markup):
        literal(markup[at : region.start()])
        plain = False
        if region[1] is not None:
            before = len(steps)
            literal(region[1])
            jumps.append((before, len(steps)))
        else:
            least, most = int(region[2]), int(region[3])
            steps.extend([None] * most)
            jumps.extend((len(steps) - k, len(steps)) for k in range(1, most - least + 1))
        at = region.end()
    literal(markup[at:])
    if not opening:
        raise ValueError("a template begins with mandatory words")
    skips = tuple(frozenset(b for a, b in jumps if a == s and b != s) for s in range(len(steps) + 1))
    return Automaton(b" " + b" ".join(opening) + b" ", tuple(steps), skips)


@lru_cache(maxsize=4)
def _compiled(templates: tuple[tuple[str, str], ...]) -> tuple[tuple[str, Automaton], ...]:
    return tuple((label, compile_template(markup)) for label, markup in templates)


def _places(text: bytes, phrase: bytes) -> Iterator[tuple[int, int]]:
    """(word number, byte position) of each place where a phrase stands."""
    at, seen, number = text.find(phrase), 0, 0
    while at >= 0:
        number += text.count(b" ", seen, at)
        seen = at
        yield number, at
        at = text.find(phrase, at + 1)


def _words_from(text: bytes, at: int) -> Iterator[bytes]:
    while at + 1 < len(text):
        end = text.index(b" ", at + 1)
        yield text[at + 1 : end]
        at = end


Match = tuple[str, int, int, bool]


def scan_text(
    data: bytes, phrases: tuple[tuple[str, str], ...], templates: tuple[tuple[str, str], ...]
) -> tuple[int, list[Match]]:
    """Number of words, and (label, first word, words, is template) of all matches."""
    text = normal_form(data)
    found: list[Match] = []
    if not text:
        return 0, found
    for phrase, label in phrases:
        needle = b" " + b" ".join(_words(phrase)) + b" "
        size = needle.count(b" ") - 1
        found.extend((label, number, size, False) for number, _ in _places(text, needle))
    for label, automaton in _compiled(templates):
        for number, at in _places(text, automaton.opening):
            size = automaton.accept(_words_from(text, at))
            if size:
                found.append((label, number, size, True))
    return text.count(b" ") - 1, found


_MATCHES = pa.list_(
    pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("template", pa.bool_())])
)


def license_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: dict[str, str] = PHRASES,
    templates: dict[str, str] = TEMPLATES,
) -> DataFrame:
    """``id``, ``n_words``, ``matches`` (label, first_word, n_words, template).

    Null text is empty: no words, no matches.  Null ids and repeated rows pass
    through, one result each; an empty table gives no rows; other columns are
    not read.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(docs[name_of(id_col)].alias("id"), docs[name_of(text_col)].alias("text"))
    fixed, marked = tuple(phrases.items()), tuple(templates.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts, matches = [], []
            for text in byte_list(batch.column("text")):
                n, found = scan_text(text, fixed, marked)
                counts.append(n)
                matches.append(
                    [dict(zip(("label", "first_word", "n_words", "template"), m)) for m in found]
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(counts, pa.int64()), pa.array(matches, _MATCHES)],
                ["id", "n_words", "matches"],
            )

    return rows.mapInArrow(
        run,
        f"id {dict(rows.dtypes)['id']}, n_words bigint, matches "
        "array<struct<label:string,first_word:bigint,n_words:bigint,template:boolean>>",
    )


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses in every whole text of ``documents``.  The score is 1 where a
    template is accepted, 0.5 where only a phrase stands, else 0."""
    found = license_scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    base = F.filter("matches", lambda m: ~m["template"])
    starts = F.transform("base", lambda m: m["first_word"])
    names = lambda column: F.array_join(F.array_sort(F.array_distinct(F.transform(column, lambda m: m["label"]))), ",")
    return found.withColumn("base", base).select(
        F.col("id").alias("doc_id"),
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        names("base").alias("base_labels"),
        names("matches").alias("labels"),
        F.when(F.exists("matches", lambda m: m["template"]), 1.0)
        .when(F.size("base") > 0, 0.5)
        .otherwise(0.0)
        .alias("score"),
    )
