"""License scans: winnowed fingerprints of templates find candidates, banded alignment confirms them.

Templates are cut into words; the hashes of their GRAM-word grams are winnowed (the smallest, rightmost
hash of each WINDOW grams) and put into an inverted index. A document is winnowed alike, so any run of GRAM + WINDOW - 1
words that it shares with a template has a common fingerprint. Hits on nearby diagonals (place in the
document less place in the template) form a candidate, which a local alignment inside that band confirms:
it reports the share of the template's words that are matched in order (coverage), the share of the span's words that
are (precision), and the span in words and characters.

One word makes another license of a text: a number, NC, ND or SA, Lesser or Affero, a family's name. So the telling words
of the span have to be those of the template, in order, and the span must not go on as a longer name does (`2` as `2.1`,
`3-Clause` as `3-Clause-Clear`). "Or later" behind a GNU license is part of its name. The head of an identifier line is
a template like others; what stands behind it is read whole, as an expression with AND, OR, WITH and brackets, and each
known identifier in it is a match. Of overlapping matches the one with the most coverage stays, then the one with more words.

The templates are a parameter of bounded size and travel to the executors; documents are scanned
where they are, whole and without a shuffle, and only words of the templates are told apart. `folder_templates` makes templates of whole license
texts in a folder. The default templates are notices, heads of license texts and identifier lines.

Defined results: null and empty texts match nothing; texts of any length are scanned whole; equal matches at several places, and repeated rows, are several
rows; ties between templates go to the first; other columns are not read and may have any name; an empty list of templates or an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

GRAM, WINDOW = 3, 2
COVERAGE = 0.8
IDENTIFIER = "SPDX-License-Identifier:"
WORDS = re.compile(r"[^\W_]+")
# Notices and permission texts as their licenses give them, without names and years.
_PERMISSION = "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
# Identifiers of licenses that come in one form each.
_SINGLE = (
    "0BSD AFL-3.0 Apache-1.0 Apache-1.1 Apache-2.0 Artistic-1.0 Artistic-2.0 BSD-1-Clause BSD-2-Clause BSD-2-Clause-Patent BSD-3-Clause BSD-3-Clause-Clear BSD-4-Clause BSL-1.0 BUSL-1.1 CC0-1.0 CDDL-1.0 CDDL-1.1 CECILL-2.1 CPL-1.0 "
    "ECL-2.0 EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2 FTL HPND ICU ISC JSON LPPL-1.3c MIT MIT-0 MPL-1.0 MPL-1.1 MPL-2.0 MPL-2.0-no-copyleft-exception MS-PL MS-RL MulanPSL-2.0 NCSA ODbL-1.0 OFL-1.1 OpenSSL OSL-3.0 "
    "PDDL-1.0 PHP-3.01 PostgreSQL PSF-2.0 Python-2.0 Ruby SSPL-1.0 Unicode-DFS-2016 Unlicense UPL-1.0 Vim W3C WTFPL X11 Zlib ZPL-2.1"
).split()
# Versions of the GNU licenses, and versions and parts of the Creative Commons licenses.
_GNU = {"GPL": ("General", ("1.0", "2.0", "3.0")), "LGPL": ("Lesser General", ("2.1", "3.0")), "AGPL": ("Affero General", ("3.0",))}
_CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
_CC_PARTS = {"BY": "Attribution", "NC": "NonCommercial", "ND": "NoDerivatives", "SA": "ShareAlike"}
_CC = ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")


def _known() -> dict[str, str]:
    """Identifiers in lower case to the names they are reported by; old ones of the GNU licenses to their present ones."""
    names = [*_SINGLE, *(f"CC-{kind}-{v}" for kind in _CC for v in _CC_VERSIONS)]
    found = {n.lower(): n for n in names}
    for family, (_, versions) in _GNU.items():
        for v in ("2.0", *versions) if family == "LGPL" else versions:
            name = f"{family}-{v}"
            for ending, present in (("", "-only"), ("-only", "-only"), ("+", "-or-later"), ("-or-later", "-or-later")):
                found[f"{name}{ending}".lower()] = name + present
    return found


KNOWN = _known()
#: Words of which one more or less names another license; a number is one too, if it isn't a year.
TELLING = frozenset(
    "lesser library affero nc nd sa by noncommercial noderivatives noderivs sharealike attribution clear patent mit apache bsd mozilla eclipse boost zlib isc cc0 artistic european microsoft gpl lgpl agpl mpl epl".split()
)
_NUMBER = re.compile(r"v?\d+[a-z]?$")
_YEAR = re.compile(r"(19|20)\d\d$")
#: Templates of more words tell themselves apart by versions; their sections' numbers don't count.
NOTICE_WORDS = 60
_GOES_ON = re.compile(r"\+|[-.]\w")
_LATER = re.compile(r"[\s,;.(]*(?:at your option[\s,;)]*)?(?:or|and)[\s(]+(?:at your option[\s,;)]*)?(?:any[\s]+)?(?:later|newer|greater|above)\b", re.IGNORECASE)
_EXPRESSION = re.compile(r"\(|\)|[A-Za-z0-9][A-Za-z0-9.:-]*\+?")


_NOTICES = (
    ("program", "GNU General Public License", "GPL-2.0", "2"),
    ("library", "GNU Lesser General Public License", "LGPL-2.1", "2.1"),
    ("program", "GNU Lesser General Public License", "LGPL-3.0", "3"),
    ("program", "GNU Affero General Public License", "AGPL-3.0", "3"),
)


def _notice(work: str, licence: str, version: str) -> str:
    return (
        f"This {work} is free software; you can redistribute it and/or modify it under the terms of the {licence} as published by the Free Software Foundation; either version {version} of the License, or (at your option) any later version. "
        f"This {work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {licence} for more details."
    )


TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + _PERMISSION),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    # The heads of whole license texts.
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0 1. Definitions"),
    *((f"{name}-or-later", _notice(work, licence, version)) for work, licence, name, version in _NOTICES),
    *((f"Apache-{v}", f"Licensed under the Apache License, Version {v}.") for v in ("1.0", "1.1", "2.0")),
    *((f"BSD-{n}-Clause", f"{verb} under the BSD {n}-Clause License.") for n in (1, 2, 3, 4) for verb in ("Released", "Licensed")),
    *((f"{name}-{v}", f"This work is licensed under the GNU {kind} Public License, version {v.removesuffix('.0')}.") for name, (kind, versions) in _GNU.items() for v in versions),
    *((f"CC-{kind}-{v}", f"Licensed under CC {kind} {v}.") for kind in _CC for v in _CC_VERSIONS),
    *((f"CC-{kind}-{v}", f"This work is licensed under a Creative Commons {'-'.join(_CC_PARTS[x] for x in kind.split('-'))} {v} {'International' if v == '4.0' else 'Unported' if v == '3.0' else ''} License.") for kind in _CC for v in _CC_VERSIONS),
    ("", IDENTIFIER),
)


class Match(NamedTuple):
    template: int
    coverage: float
    matched: int
    start: int
    end: int


class Found(NamedTuple):
    """A license at a place of a text; `expression` is what an identifier line says in full."""

    license: str
    template: int
    coverage: float
    precision: float
    matched: int
    start: int
    end: int
    start_char: int
    end_char: int
    expression: str | None


def align(doc: np.ndarray, pattern: np.ndarray, low: int, high: int) -> Match | None:
    """Best local alignment of pattern in doc with place in doc less place in pattern in low..high.

    A match counts 2, a mismatch or gap -1; of equal scores the one with more matches, then the earlier start. A cell holds all
    three in one number, and a row of cells, one for each diagonal, is worked out at once: extra words of the document
    are a running maximum along it. The match's template is left at -1.
    """
    one, hit, last = 1 << 44, 1 << 22, (1 << 22) - 1
    doc, pattern = np.asarray(doc, np.int64), np.asarray(pattern, np.int64)
    width = high - low + 1
    if max(len(doc), len(pattern)) > last or not len(doc):
        if len(doc):
            raise ValueError(f"a template's surroundings may have {last} words")
        return None
    along = np.arange(width, dtype=np.int64)
    before, best, end = np.zeros(width + 1, np.int64), 0, 0
    for j, p in enumerate(pattern.tolist()):
        i = j + low + along
        inside = (i >= 0) & (i < len(doc))
        same = inside & (doc[np.clip(i, 0, len(doc) - 1)] == p)
        fresh = 2 * one + hit + (last - i)
        cell = np.where(same, np.where(before[:-1] > 0, before[:-1] + (2 * one + hit), fresh), before[:-1] - one)
        cell = np.maximum(cell, before[1:] - one)
        cell[(cell < one) | ~inside] = 0
        if cell.any():
            cell = np.maximum.accumulate(cell + along * one * (cell > 0)) - along * one
            cell[(cell < one) | ~inside] = 0
            k = int(cell.argmax())
            if cell[k] > best:
                best, end = int(cell[k]), int(i[k]) + 1
        before[:-1] = cell
    matched = (best // hit) % hit
    return Match(-1, matched / len(pattern), matched, last - best % hit, end) if best else None


def telling(words: Sequence[str], long: bool) -> list[str]:
    """The words that one license differs in from another; in a long text of the numbers only those of versions."""
    out = []
    for before, w, after in zip(["", *words], words, [*words[1:], ""], strict=False):
        if w == "by" and before != "cc" or w == "library" and after != "general":
            continue
        if w in TELLING or (_NUMBER.match(w) and not _YEAR.match(w) and (not long or before in ("version", "v"))):
            out.append(w)
    return out


def expression(text: str) -> tuple[list[tuple[str, int, int]], int]:
    """The identifiers, with their places, of the license expression that a text begins with, and where that ends."""
    line = text.split("\n", 1)[0]
    tokens = []
    at = 0
    while m := _EXPRESSION.match(line, at + len(line[at:]) - len(line[at:].lstrip(" \t"))):
        tokens.append(m)
        at = m.end()

    def read(i: int) -> tuple[int, list[tuple[str, int, int]]] | None:
        """An operand and what AND and OR join to it: the token behind it, and its identifiers."""
        if i < len(tokens) and tokens[i][0] == "(":
            inner = read(i + 1)
            if not inner or inner[0] >= len(tokens) or tokens[inner[0]][0] != ")":
                return None
            i, found = inner[0] + 1, inner[1]
        elif i < len(tokens) and tokens[i][0] not in (")", "AND", "OR", "WITH"):
            name = tokens[i][0].rstrip(".:-")
            found = [(name, tokens[i].start(), tokens[i].start() + len(name))]
            i += 1
            if i + 1 < len(tokens) and tokens[i][0] == "WITH":
                i += 2
        else:
            return None
        if i < len(tokens) and tokens[i][0] in ("AND", "OR"):
            more = read(i + 1)
            if more:
                return more[0], found + more[1]
        return i, found

    whole = read(0)
    return (whole[1], tokens[whole[0] - 1].end()) if whole else ([], 0)


def winnowed(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Places of the smallest, rightmost hash of each window; of all if there are fewer than a window."""
    n = len(hashes)
    if n <= window:
        return np.flatnonzero(hashes[::-1] == hashes.min())[:1] * -1 + n - 1 if n else np.zeros(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(hashes, window)
    return np.unique(np.arange(n - window + 1) + window - 1 - view[:, ::-1].argmin(1))


def grams(ids: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash for each run of `gram` words."""
    n = len(ids) - gram + 1
    out = np.zeros(max(0, n), np.uint64)
    for k in range(gram if n > 0 else 0):
        out = (out ^ (ids[k : k + n] + 2).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


class Scanner:
    """Templates with their inverted index of fingerprints."""

    def __init__(self, templates: Sequence[tuple[str, str]], coverage: float = COVERAGE, gram: int = GRAM, window: int = WINDOW):
        self.templates, self.coverage, self.gram, self.window = list(templates), coverage, gram, window
        self.ids: dict[str, int] = {}
        words = [WORDS.findall(text.lower()) for _, text in self.templates]
        self.patterns = [np.array([self.ids.setdefault(w, len(self.ids)) for w in found], np.int64) for found in words]
        self.tells = [telling(found, len(found) > NOTICE_WORDS) for found in words]
        #: Fingerprints of templates below a window, which a document's windows need not keep.
        self.short: list[int] = []
        index: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for t, pattern in enumerate(self.patterns):
            hashes = grams(pattern, gram)
            if len(hashes) < window:
                self.short += hashes.tolist()
            for at in winnowed(hashes, window).tolist():
                index[int(hashes[at])].append((t, at))
        self.index = dict(index)
        self.known = np.array(sorted(self.index), np.uint64)

    def clusters(self, ids: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Template and range of diagonals of each candidate."""
        hashes = grams(ids, self.gram)
        places = winnowed(hashes, self.window)
        for h in self.short:
            places = np.union1d(places, np.flatnonzero(hashes == np.uint64(h)))
        if not len(places) or not len(self.known):
            return
        own = hashes[places]
        at = np.minimum(np.searchsorted(self.known, own), len(self.known) - 1)
        hits: dict[int, set[int]] = defaultdict(set)
        for place, h in zip(places[self.known[at] == own].tolist(), own[self.known[at] == own].tolist(), strict=True):
            for t, where in self.index[h]:
                hits[t].add(place - where)
        for t, diagonals in sorted(hits.items()):
            band = max(2, len(self.patterns[t]) // 8)
            low = last = None
            for d in sorted(diagonals):
                if last is not None and d - last > band:
                    yield t, low - band, last + band
                    low = d
                low, last = d if low is None else low, d
            yield t, low - band, last + band

    def confirmed(self, words: Sequence[str], ids: np.ndarray, t: int, low: int, high: int) -> Match | None:
        """The alignment with a template near these diagonals, if enough of both is matched and the telling words agree."""
        a, b = max(0, low), max(0, high + len(self.patterns[t]))
        m = align(ids[a:b], self.patterns[t], low - a, high - a)
        if not m or m.coverage < (self.coverage if self.templates[t][0] else 1.0) or m.matched < self.coverage * (m.end - m.start):
            return None
        m = m._replace(template=t, start=m.start + a, end=m.end + a)
        return m if telling(words[m.start : m.end], len(self.patterns[t]) > NOTICE_WORDS) == self.tells[t] else None

    def scan(self, text: str) -> list[Found]:
        """Matches in the order of the text."""
        words = WORDS.findall(text.lower())
        ids = np.fromiter((self.ids.get(w, -1) for w in words), np.int64, len(words))
        found = [m for t, low, high in self.clusters(ids) if (m := self.confirmed(words, ids, t, low, high))]
        if not found:
            return []
        spans = [w.span() for w in WORDS.finditer(text)]
        if len(spans) != len(words):  # lower case changed the words' number: places in lower case
            text = text.lower()
            spans = [w.span() for w in WORDS.finditer(text)]
        chosen: list[Match] = []
        for m in sorted(set(found), key=lambda m: (-m.coverage, -m.matched, m.start, m.template)):
            if all(m.end <= c.start or c.end <= m.start for c in chosen):
                chosen.append(m)
        out = []
        for m in chosen:
            start, end, name = spans[m.start][0], spans[m.end - 1][1], self.templates[m.template][0]
            if not name:
                behind = end + len(text[end:]) - len(text[end:].lstrip(": \t"))
                names, stop = expression(text[behind:])
                whole = text[behind : behind + stop]
                out += [Found(KNOWN[n.lower()], m.template, 1.0, 1.0, m.matched, m.start, m.end, start, behind + b, whole) for n, _, b in names if n.lower() in KNOWN]
                continue
            if _GOES_ON.match(text, end) and not (text[end] == "." and text[end + 1] in "_"):
                continue
            if re.fullmatch(r"[AL]?GPL-\d\.\d", name) and (later := _LATER.match(text, end)):
                name, end = f"{name}-or-later", later.end()
            out.append(Found(name, m.template, m.coverage, m.matched / (m.end - m.start), m.matched, m.start, m.end, start, end, None))
        return sorted(out, key=lambda f: (f.start, f.end_char))


def _scanned(batches: Iterator[pa.RecordBatch], scanner: Scanner) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    names = ["license", "template", "coverage", "precision", "matched_words", "start_word", "end_word", "start_char", "end_char", "expression"]
    for batch in batches:
        rows, at = [], []
        for i, text in enumerate(batch.column(1)):
            for f in scanner.scan(text.as_py() or ""):
                at.append(i)
                rows.append(f._replace(template=f"{zlib.crc32(scanner.templates[f.template][1].encode()):08x}"))
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names=["id", *names])


#: Bytes of templates that are sent along with the tasks.
TEMPLATE_BYTES = 5_000_000


def folder_templates(spark: SparkSession, path: str) -> tuple[tuple[str, str], ...]:
    """Whole license texts as templates: one for each file of a folder, named by its file's name without `.txt`.

    Their size is bounded, as they travel to the executors; a folder of more is an error.
    """
    files = spark.read.format("binaryFile").load(path)
    size = files.agg(F.sum("length")).first()[0] or 0
    if size > TEMPLATE_BYTES:
        raise ValueError(f"{size} bytes of templates; at most {TEMPLATE_BYTES}")
    rows = files.select(F.regexp_extract("path", r"([^/]+?)(\.txt)?$", 1).alias("name"), F.col("content").cast("string").alias("text")).collect()
    return tuple(sorted((r.name, r.text) for r in rows))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: Sequence[tuple[str, str]] = TEMPLATES, coverage: float = COVERAGE) -> DataFrame:
    """One row for each match: id, license, template (its checksum), coverage, precision, matched_words, the spans and the expression of an identifier line."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    fixed = tuple(templates)
    schema = f"id {kind}, license string, template string, coverage double, precision double, matched_words long, start_word long, end_word long, start_char long, end_char long, expression string"
    return rows.mapInArrow(lambda it: _scanned(it, Scanner(fixed, coverage)), schema)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
