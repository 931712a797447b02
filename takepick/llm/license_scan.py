"""License scans by patience alignment of documents with license templates.

Anchors are words found once in both the text and the template; the longest
increasing subsequence of them is matched and the gaps are aligned in their turn
(:mod:`takepick.llm.patience`).  A match may lie anywhere in a text of any
length: words of the template are aligned window after window, and the aligned words are
cut where they lie far apart.  Coverage is the matched share of the template.

Licenses differ by a word or a number, so a template states in braces the phrases
that tell it from others: each must be matched word for word.  In brackets it states phrases of other
licenses that go on where it ends: none may be in the match or in the ``AFTER`` words after it, up to
the next notice of its kind.  Of templates that match at overlapping places the one with the most matched words is
reported, so a notice that contains another's words has its own name.  A statement in one
sentence with a negation ("not released under ...") is none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from takepick.llm.common import text_batches
from takepick.llm.patience import align

AFTER = 150
NEGATION = re.compile(r"\b(?:not|never|neither|nor|cannot|no longer|\w+n['’]t)\b", re.I)
#: Phrases of licenses that begin as the BSD licenses do.
OTHER_BSD = "[all advertising materials] [subject to the limitations in the disclaimer below] [each copyright holder and contributor hereby grants] [endorse or promote products]"
#: Fixed value: the conditions that the BSD licenses share.
BSD_CONDITIONS = (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. "
)
#: License notices as they are commonly written; phrases in braces must be there word for word, those in brackets must not follow.
#: What a name has after a slash tells variants of one license apart.
TEMPLATES = {
    "MIT (statement)": "Released under the {MIT License}.",
    "BSD (statement)": "Released under the {BSD License}.",
    "ISC (statement)": "Released under the {ISC License}.",
    "Apache-1.0 (statement)": "Licensed under the {Apache License, Version 1.0}.",
    "Apache-1.1 (statement)": "Licensed under the {Apache License, Version 1.1}.",
    "Apache-2.0 (statement)": "Licensed under the {Apache License, Version 2.0}.",
    "MPL-1.1 (statement)": "Licensed under the {Mozilla Public License, version 1.1}.",
    "MPL-2.0 (statement)": "Licensed under the {Mozilla Public License, version 2.0}.",
    "GPL-2.0 (statement)": "This work is licensed under the {GNU General Public License}, {version 2}.",
    "GPL-3.0 (statement)": "This work is licensed under the {GNU General Public License}, {version 3}.",
    "LGPL-2.1 (statement)": "This work is licensed under the {GNU Lesser General Public License}, {version 2.1}.",
    "LGPL-3.0 (statement)": "This work is licensed under the {GNU Lesser General Public License}, {version 3}.",
    "AGPL-3.0 (statement)": "This work is licensed under the {GNU Affero General Public License}, {version 3}.",
    "CC-BY-4.0 (statement)": "Licensed under {CC BY 4.0}.",
    "CC-BY-SA-4.0 (statement)": "Licensed under {CC BY-SA 4.0}.",
    "CC-BY-ND-4.0 (statement)": "Licensed under {CC BY-ND 4.0}.",
    "CC-BY-NC-4.0 (statement)": "Licensed under {CC BY-NC 4.0}.",
    "CC-BY-NC-SA-4.0 (statement)": "Licensed under {CC BY-NC-SA 4.0}.",
    "CC-BY-NC-ND-4.0 (statement)": "Licensed under {CC BY-NC-ND 4.0}.",
    "reserved (statement)": "{All rights reserved}.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "{publish, distribute, sublicense}, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and {this permission notice shall be included} in all copies or "
        "substantial portions of the Software. [used for good not evil] [except as contained in this notice the name] [visible changes]"
    ),
    "JSON": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and {this permission notice shall be included} in all copies or "
        "substantial portions of the Software. The Software shall be {used for Good, not Evil}."
    ),
    "MIT-0": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "{publish, distribute, sublicense}, and/or sell copies of the Software, and to permit persons to whom the Software is furnished {to do so}. "
        "[subject to the following] [this permission notice] [redistributions of]"
    ),
    "0BSD": "{Permission to use}, copy, modify, and/or distribute this software for any purpose {with or without fee is hereby granted}. [provided that] [appear in all copies]",
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose {with or without fee is hereby granted}, provided that "
        "the above copyright notice and {this permission notice appear in all copies}. [supporting documentation] [without specific written prior permission]"
    ),
    "HPND": (
        "Permission to use, copy, modify and distribute {this software and its documentation for any purpose and without fee} is hereby granted, provided that the "
        "above copyright notice appear in all copies and that both that copyright notice and this permission notice appear in {supporting documentation}."
    ),
    **{
        name: BSD_CONDITIONS + rest
        for name, rest in (
            ("BSD-2-Clause", OTHER_BSD),
            ("BSD-3-Clause", "{Neither the name} of the copyright holder nor the names of its contributors may be used to {endorse or promote products} derived from this software without specific prior written permission. " + OTHER_BSD.replace("[endorse or promote products]", "")),
            ("BSD-3-Clause/author", "{The name of the author may not be used} to {endorse or promote products} derived from this software without specific prior written permission. " + OTHER_BSD.replace("[endorse or promote products]", "")),
            ("BSD-4-Clause", "All {advertising materials} mentioning features or use of this software {must display the following acknowledgement}: This product includes software developed by the organization. Neither the name of the copyright holder nor the names of its contributors may be used to {endorse or promote products} derived from this software without specific prior written permission."),
        )
    },
    "Apache-2.0": (
        "Licensed under the {Apache License, Version 2.0} (the \"License\"); you may not use this file except in compliance with the License. You "
        "may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied. See the License for the specific language governing permissions and limitations under the License."
    ),
    **{
        f"{short}-{version}": (
            f"This program is free software: you can redistribute it and/or modify it under the terms of the {{GNU {name} License}} as published "
            f"by the Free Software Foundation, either {{version {said}}} of the License, or (at your option) any later version."
        )
        for short, name, version, said in (
            ("GPL", "General Public", "2.0", "2"),
            ("GPL", "General Public", "3.0", "3"),
            ("LGPL", "Lesser General Public", "2.1", "2.1"),
            ("LGPL", "Lesser General Public", "3.0", "3"),
            ("AGPL", "Affero General Public", "3.0", "3"),
        )
    },
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the {Mozilla Public License, v. 2.0}. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": "This is free and {unencumbered software} released into the public domain.",
}
WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


class Template:
    """A template's words, the places of the phrases that must be matched word for word, and the phrases that must not follow."""

    def __init__(self, name: str, text: str):
        self.name, self.words, self.phrases = name.partition("/")[0], [], []
        self.statement = name.endswith("(statement)")
        self.forbidden = [tuple(words(x)) for x in re.findall(r"\[([^]]*)\]", text)]
        for n, part in enumerate(re.split("[{}]", re.sub(r"\[[^]]*\]", "", text))):
            more = words(part)
            if n % 2 and more:
                self.phrases.append(range(len(self.words), len(self.words) + len(more)))
            self.words += more
        self.distinct = set(self.words)
        self.needed = {self.words[j] for p in self.phrases for j in p}
        self.gap = max(4, len(self.words) // 2)

    def holds(self, pairs: list[tuple[int, int]]) -> bool:
        place = {j: i for i, j in pairs}
        return all(place.get(p[0], -1) >= 0 and all(place.get(j) == place[p[0]] + j - p[0] for j in p) for p in self.phrases)

    def stands(self, text: list[str], first: int, n: int, missed: int) -> bool:
        """Whether no forbidden phrase is in the match, in what comes before it for the ``missed`` words of the template's start, or goes on after it."""
        end = min(len(text), first + n + AFTER)
        opening = self.words[:4]
        for i in range(first + n, end) if self.forbidden else ():
            if text[i : i + 4] == opening:  # the next notice
                end = i
                break
        there = text[max(0, first - 2 * missed) : end]
        return not any(tuple(there[i : i + len(x)]) == x for x in self.forbidden for i in range(len(there) - len(x) + 1))


def negated(text: str, first: int, n: int) -> bool:
    """Whether the sentence that words ``first`` to ``first + n`` are in says no before they end."""
    found = list(islice(WORD.finditer(text), first, first + n))
    start = max(text.rfind(c, 0, found[0].start()) for c in ".!?\n") + 1
    return NEGATION.search(text, start, found[-1].end()) is not None


def parts(pairs: list[tuple[int, int]], gap: int) -> list[list[tuple[int, int]]]:
    """Matches (in text, in template) cut where the text between them is longer than ``gap``."""
    out: list[list[tuple[int, int]]] = []
    for p in pairs:
        if out and p[0] - out[-1][-1][0] <= gap:
            out[-1].append(p)
        else:
            out.append([p])
    return out


Match = tuple[int, int, int]  # words matched, first word, number of words


def apart(found: list[Match]) -> list[int]:
    """Places in ``found`` of matches that don't overlap, those of most words first, then the shorter, then the earlier."""
    kept: list[int] = []
    for i in sorted(range(len(found)), key=lambda i: (-found[i][0], found[i][2], found[i][1], i)):
        if all(found[i][1] + found[i][2] <= found[k][1] or found[k][1] + found[k][2] <= found[i][1] for k in kept):
            kept.append(i)
    return sorted(kept, key=lambda i: found[i][1])


def scan(text: list[str], template: Template, least: float = 0.8) -> list[Match]:
    """All places of a text where at least that share of the template is matched, and its phrases are."""
    at = [i for i, w in enumerate(text) if w in template.distinct]
    size = len(template.words)
    found: dict[Match, None] = {}
    start = 0
    for k in range(1, len(at) + 1):
        if k == len(at) or at[k] - at[k - 1] > template.gap:  # stretches of template words, each by itself
            stretch = at[start:k]
            start = k
            if len(stretch) < least * size:
                continue
            # a stretch may hold the notice several times: each lies within one of these windows
            step, span = max(1, size // 4), size + size // 2
            for a in range(0, max(1, len(stretch) - size // 2), step):
                rows = stretch[a : a + span]
                for kept in parts([(rows[i], j) for i, j in align([text[r] for r in rows], template.words)], template.gap):
                    match = len(kept), kept[0][0], kept[-1][0] - kept[0][0] + 1
                    if len(kept) >= least * size and template.holds(kept) and template.stands(text, *match[1:], kept[0][1]):
                        found[match] = None
    every = list(found)
    return [every[i] for i in apart(every)]


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per notice found: doc_id, license, coverage, first_word, n_words.

    ``coverage`` is the share of the template's words that align, ``least`` the
    smallest that is reported.  Words are runs of letters and digits in lower
    case, with inner dots and hyphens.  A notice held several times has a row for
    each; of templates matched at overlapping places one is reported.  Null and
    empty texts have no rows.  Null and repeated ids are carried as they are, each
    row scanned by itself.  No rows give no rows; other columns are ignored.
    """
    all_ = [t for t in (Template(*x) for x in (TEMPLATES if templates is None else templates).items()) if t.words]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        any_ = set().union(*(t.distinct for t in all_))
        for batch in text_batches(batches, "text"):
            out: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                # a cheap bound first: at least this share of a template's words must be there at all
                mine = words(text)
                there = any_.intersection(mine)
                near = [t for t in all_ if there and t.needed <= there and len(t.words) - len(t.distinct - there) >= least * len(t.words)]
                found = [(m, t) for t in near for m in scan(mine, t, least) if not (t.statement and negated(text, *m[1:]))]
                for i in apart([m for m, _ in found]):
                    (matched, first, n), t = found[i]
                    out.append((doc, t.name, matched / len(t.words), first, n))
            kinds = (pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64())
            names = ["doc_id", "license", "coverage", "first_word", "n_words"]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, license string, coverage double, first_word long, n_words long"
    )
