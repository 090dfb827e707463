from __future__ import annotations

import random

import numpy as np

from graftline.llm import license_scan as ls


def slow_align(doc, pattern):
    """Local alignment of all cells, one by one: the best (score, matches, earliest start)."""
    best, before = (0, 0, 0, 0), [(0, 0, 0)] * (len(doc) + 1)
    for p in pattern:
        row = [(0, 0, 0)]
        for i, d in enumerate(doc):
            s, m, start = before[i] if before[i][0] else (0, 0, -i)
            cell = max((s + (2 if d == p else -1), m + (d == p), start), (before[i + 1][0] - 1, *before[i + 1][1:]), (row[i][0] - 1, *row[i][1:]))
            row.append(cell if cell[0] > 0 else (0, 0, 0))
            best = max(best, (*row[-1], -i - 1))
        before = row
    return best


def test_alignment_equals_all_cells():
    rng = random.Random(1)
    for _ in range(400):
        doc, pattern = ([rng.randrange(4) for _ in range(rng.randint(1, 14))] for _ in range(2))
        want = slow_align(doc, pattern)
        got = ls.align(np.array(doc), np.array(pattern), -len(pattern), len(doc))
        assert (got is None) == (want[0] == 0)
        if got:
            assert got.matched == want[1] and got.start == -want[2]


def brute(scanner, text):
    """The best alignment of every template over the whole text, without index and bands."""
    words = ls.WORDS.findall(text.lower())
    ids = np.array([scanner.ids.get(w, -1) for w in words])
    found = {scanner.confirmed(words, ids, t, -len(pattern), len(ids)) for t, pattern in enumerate(scanner.patterns)}
    spans = [w.span() for w in ls.WORDS.finditer(text)]
    return {(m.template, m.matched, m.start, m.end) for m in found if m and not ls._GOES_ON.match(text, spans[m.end - 1][1])}


def test_finds_what_brute_force_finds():
    rng = random.Random(2)
    scanner = ls.Scanner([t for t in ls.TEMPLATES if t[0]])
    vocab = [*scanner.ids, *(f"zz{i}" for i in range(400))]
    for _ in range(150):
        t = rng.randrange(len(scanner.templates))
        words = scanner.templates[t][1].split()
        for _ in range(len(words) // 12):
            at = rng.randrange(len(words))
            words[at : at + 1] = rng.choice([[], [rng.choice(vocab)], [words[at], "zz9"]])
        noise = [[rng.choice(vocab) for _ in range(rng.randint(0, 40))] for _ in range(2)]
        text = " ".join([*noise[0], *words, *noise[1]])
        best = brute(scanner, text)
        got = scanner.scan(text)
        top = max(((m[1] / len(scanner.patterns[m[0]]), m[1]) for m in best), default=None)
        if top:
            assert top in [(f.coverage, f.matched) for f in got], (text, best, got)
        assert {(f.template, f.matched, f.start, f.end) for f in got} <= best | {(f.template, f.matched, f.start, f.end) for f in got if f.matched >= 4}


def test_spans_and_repeats():
    scanner = ls.Scanner(ls.TEMPLATES)
    text = "Ein Text.\nReleased under the MIT License. Mehr. Released under the MIT license!\nLicensed under CC BY-NC 4.0."
    got = [(f.license, f.coverage, text[f.start_char : f.end_char]) for f in scanner.scan(text)]
    assert got == [("MIT", 1.0, "Released under the MIT License"), ("MIT", 1.0, "Released under the MIT license"), ("CC-BY-NC-4.0", 1.0, "Licensed under CC BY-NC 4.0")]
    assert scanner.scan("the license of the public is under version 3") == [] == scanner.scan("")
    many = "Licensed under the Apache License, Version 2.0. " * 300
    assert len(scanner.scan(many)) == 300


def test_edge_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "x Released under the MIT License.", "a"), (3, "x Released under the MIT License.", "a"), (None, "Licensed under CC BY 4.0.", "a"), (5, "word " * 50000 + "This work is licensed under the GNU General Public License, version 3.", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, license string")
    got = sorted((str(r.id), r.license, r.coverage) for r in ls.scan_licenses(docs).collect())
    assert got == [("3", "MIT", 1.0), ("3", "MIT", 1.0), ("5", "GPL-3.0", 1.0), ("None", "CC-BY-4.0", 1.0)]
    assert ls.scan_licenses(docs.limit(0)).count() == 0 and ls.scan_licenses(docs, templates=()).count() == 0


def test_notices_heads_and_identifiers():
    scanner = ls.Scanner(ls.TEMPLATES)
    cases = {
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007": "GPL-3.0",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991": "GPL-2.0",
        "Licensed under the BSD-3-Clause licence": "BSD-3-Clause",
        "// SPDX-License-Identifier: MIT": "MIT",
        "# SPDX-License-Identifier: GPL-2.0-or-later": "GPL-2.0-or-later",
        ls._notice("program", "GNU General Public License", "2"): "GPL-2.0-or-later",
        ls._notice("library", "GNU Lesser General Public License", "2.1"): "LGPL-2.1-or-later",
        ls._notice("program", "GNU Affero General Public License", "3"): "AGPL-3.0-or-later",
        dict(ls.TEMPLATES)["GPL-3.0-or-later"]: "GPL-3.0-or-later",
    }
    for text, name in cases.items():
        assert [f.license for f in scanner.scan(f"some words before {text} and behind it")] == [name], text
    assert not scanner.scan("SPDX-License-Identifier: Unknown-1.0")


NEIGHBOURS = {
    "SPDX-License-Identifier: CC-BY-NC-4.0": ["CC-BY-NC-4.0"],
    "SPDX-License-Identifier: CC-BY-NC-ND-4.0": ["CC-BY-NC-ND-4.0"],
    "SPDX-License-Identifier: CC-BY-NC-SA-4.0": ["CC-BY-NC-SA-4.0"],
    "SPDX-License-Identifier: LicenseRef-MIT": [],
    "SPDX-License-Identifier: BSD-3-Clause-Clear": ["BSD-3-Clause-Clear"],
    "Licensed under CC BY-NC-ND 4.0.": ["CC-BY-NC-ND-4.0"],
    "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.": ["CC-BY-NC-4.0"],
    "This work is licensed under a Creative Commons Attribution 3.0 International License.": ["CC-BY-3.0"],
    "Licensed under CC BY 5.0.": [],
    "This work is licensed under the GNU General Public License, version 1.": ["GPL-1.0"],
    "This work is licensed under the GNU General Public License, version 4.": [],
    "This work is licensed under the GNU Lesser General Public License, version 2.1.": ["LGPL-2.1"],
    "This work is licensed under the GNU General Public License, version 2 or any later version": ["GPL-2.0-or-later"],
    "Released under the BSD 2-Clause License.": ["BSD-2-Clause"],
    "Released under the BSD 4-Clause License.": ["BSD-4-Clause"],
    "Released under the BSD 5-Clause License.": [],
    "SPDX-License-Identifier: GPL-2.0": ["GPL-2.0-only"],
    "SPDX-License-Identifier: GPL-2.0+": ["GPL-2.0-or-later"],
    "SPDX-License-Identifier: Apache-2.0 OR MIT": ["Apache-2.0", "MIT"],
    "SPDX-License-Identifier: (GPL-2.0-only WITH Linux-syscall-note) OR BSD-3-Clause */": ["GPL-2.0-only", "BSD-3-Clause"],
    "SPDX-License-Identifier: MIT AND (Zlib OR": ["MIT"],
    "SPDX-License-Identifier:": [],
}


def test_neighbours_of_templates_are_not_taken_for_them():
    scanner = ls.Scanner(ls.TEMPLATES)
    for text, names in NEIGHBOURS.items():
        assert [f.license for f in scanner.scan(f"Before it. {text}\nAnd behind it.")] == names, text
    assert {f.expression for f in scanner.scan("SPDX-License-Identifier: Apache-2.0 OR MIT")} == {"Apache-2.0 OR MIT"}


def test_every_template_is_its_own_license_and_no_other():
    scanner = ls.Scanner(ls.TEMPLATES)
    for name, text in ls.TEMPLATES:
        for f in scanner.scan(f"{text}\n") if name else []:
            assert f.license in (name, f"{name}-or-later"), (name, f)
        # every single change of a telling word makes it another text
        words = text.split()
        for at, w in enumerate(words):
            if name and any(c.isdigit() for c in w) and len(words) < ls.NOTICE_WORDS and "www" not in w and not ls._YEAR.match(w.strip(".,")):
                other = " ".join([*words[:at], "".join("8" if c.isdigit() else c for c in w), *words[at + 1 :]])
                assert name not in [f.license for f in scanner.scan(other)], other


def test_whole_texts_from_a_folder(spark, tmp_path):
    rng = random.Random(4)
    vocab = [f"word{i}" for i in range(900)]
    texts = {"One-1.0": " ".join(rng.choice(vocab) for _ in range(2500)) + " version 1", "Two-1.0": " ".join(rng.choice(vocab) for _ in range(1500))}
    for name, text in texts.items():
        (tmp_path / f"{name}.txt").write_text(text)
    templates = ls.folder_templates(spark, str(tmp_path))
    assert dict(templates) == texts
    changed = [w for i, w in enumerate(texts["One-1.0"].split()) if i % 50 != 7]
    docs = spark.createDataFrame([(1, "x " * 70 + " ".join(changed)), (2, texts["Two-1.0"]), (3, texts["One-1.0"].replace("version 1", "version 2"))], "doc_id long, text string")
    got = {(r.id, r.license): r.coverage for r in ls.scan_licenses(docs, templates=templates).collect()}
    assert set(got) == {(1, "One-1.0"), (2, "Two-1.0")} and got[2, "Two-1.0"] == 1.0 and 0.97 < got[1, "One-1.0"] < 1
