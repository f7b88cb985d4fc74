"""License scan by conditional compression.

1. Candidate blocks: lines with a cue word, and runs of lines in which cues are at most ``GAP`` lines apart, with
   ``AROUND`` lines on either side.
2. The words of a block are compressed alone and with each template, of which the block has the critical and enough other
   words, as a zstandard raw dictionary. Templates are ranked by how many bytes they save; those that save none are out.
3. The winners are confirmed in this order by the exact wording: the template's words are aligned with the block's and the
   differing words counted, but for the template's own blanks. A template is confirmed if no critical word (one with a
   digit, or one of ``CRITICAL``) differs and at most one word in ``TOLERANCE`` does. The first that is confirmed is taken.
4. What lies between its wordings is compressed, ranked and confirmed again, until nothing more is.
5. A wording after a word of denial in its sentence (``DENIALS``) is not reported.

One row per document, also for those without a license. A null text counts as empty. Texts of any length are scanned
whole; lines longer than ``LINE_WORDS`` words are read in overlapping parts. Every row is judged by itself, so empty tables,
repeated rows and other columns change nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import cache
from itertools import product

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words that mark a candidate line, in lower case.
CUES = (
    "licen", "copyright", "(c)", "©", "all rights reserved", "creative commons", "cc by", "cc-by", "cc0", "permission is hereby", "permission to use",
    "warrant", "redistribut", "public domain", "spdx", "apache", "bsd", "gnu ", "gpl",
)
#: Words that may not differ.
CRITICAL = frozenset(
    "no not non only later lesser affero mit apache bsd isc mozilla gnu gpl lgpl agpl mpl cc by by-nc by-nd by-sa by-nc-sa by-nc-nd unlicense reserved".split()
)
GAP, AROUND, TOLERANCE, LINE_WORDS = 8, 5, 10, 2000
#: Words that deny what follows, within so many words.
DENIALS = frozenset("not never neither nor cannot isn aren wasn without".split())
DENIAL_WORDS = 6
#: Blocks whose outcome a task remembers.
CACHE_BLOCKS = 1 << 14

#: Wordings of public licenses and notices. <> is a blank of up to BLANK_WORDS words.
BLANK_WORDS = 16
_DISCLAIMER = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE "
    "FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
    "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
    "are met: <> Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "<> Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution."
)
_GNU = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} Public License as published by "
    "the Free Software Foundation, either version {1} of the License, or (at your option) any later version."
)
_LIBRARY = (
    "This library is free software; you can redistribute it and/or modify it under the terms of the GNU {0} Public License as published by "
    "the Free Software Foundation; either version {1} of the License, or (at your option) any later version."
)
#: Spellings of the parts of Creative Commons names.
_CC_PARTS = {
    "BY": ("Attribution",),
    "SA": ("ShareAlike", "Share Alike"),
    "NC": ("NonCommercial", "Non-Commercial"),
    "ND": ("NoDerivatives", "NoDerivs", "No Derivative Works"),
}
_CC_KINDS = ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")
_GNU_VERSIONS = (
    *[("GPL", "General", version) for version in ("1.0", "2.0", "3.0")],
    ("LGPL", "Library General", "2.0"),
    *[("LGPL", "Lesser General", version) for version in ("2.1", "3.0")],
    *[("AGPL", "Affero General", version) for version in ("1.0", "3.0")],
    *[("GFDL", "Free Documentation", version) for version in ("1.1", "1.2", "1.3")],
)


def _gnu(form: str, name: str, version: str) -> list[str]:
    """The names with the version, and also without its last part if that is 0."""
    words = name if name == "Free Documentation" else f"{name} Public"
    return [form.format(words, number) for number in dict.fromkeys((version, version.removesuffix(".0")))]


#: Spellings of the short GNU names.
_GNU_SHORT = ("under the {0}v{1}", "under {0}v{1}", "License: {0}v{1}", "GNU {0}v{1}", "{0}v{1} License", "under the {0} version {1}", "GNU {0} version {1}", "License: {0}-{1}.0")

TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
        "the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software. " + _DISCLAIMER,
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may '
        "obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or '
        "implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-2-Clause", _BSD),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    (
        "BSD-3-Clause",
        _BSD + " <> Neither the name of <> nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", _GNU.format("General", "3")),
    ("GPL-2.0", _GNU.format("General", "2")),
    ("AGPL-3.0", _GNU.format("Affero General", "3")),
    ("LGPL-3.0", _GNU.format("Lesser General", "3")),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at <>",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        "above copyright notice and this permission notice appear in all copies.",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "To the extent possible under law, <> has waived all copyright and related or neighboring rights to this work."),
    ("all-rights-reserved", "All rights reserved."),
    *[
        (f"CC-{kind}-{version}", form.format(kind, version))
        for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")
        for version in ("3.0", "4.0")
        for form in ("Licensed under CC {0} {1}.", "This work is licensed under CC {0} {1}.")
    ],
    *[(f"CC-{kind}-{version}", f"CC {kind} {version}") for kind in _CC_KINDS for version in ("1.0", "2.0", "2.5", "3.0", "4.0")],
    *[
        (f"CC-{kind}{version and '-'}{version}", f"Creative Commons {'-'.join(names)} {version or 'License'}")
        for kind in _CC_KINDS
        for names in product(*[_CC_PARTS[part] for part in kind.split("-")])
        for version in ("", "1.0", "2.0", "2.5", "3.0", "4.0")
    ],
    *[("CC0-1.0", text) for text in ("CC0 1.0 Universal", "under CC0 1.0", "License: CC0 1.0", "Creative Commons Zero v1.0 Universal", "Creative Commons Zero 1.0")],
    *[
        (f"{short}-{version}", text)
        for short, name, version in _GNU_VERSIONS
        for form in ("GNU {0} License, version {1}", "GNU {0} License v{1}")
        for text in _gnu(form, name, version)
    ],
    *[
        (f"{short}-{version}", f"SPDX-License-Identifier: {short}-{version}{tail}")
        for short, _, version in _GNU_VERSIONS
        for tail in ("", "-only", "-or-later")
    ],
    ("GPL-1.0", _GNU.format("General", "1")),
    ("LGPL-2.1", _GNU.format("Lesser General", "2.1")),
    ("LGPL-2.0", _LIBRARY.format("Library General", "2")),
    ("LGPL-2.1", _LIBRARY.format("Lesser General", "2.1")),
    ("LGPL-3.0", _LIBRARY.format("Lesser General", "3")),
    ("MIT", "under the MIT License"),
    ("Apache-2.0", "Apache License, Version 2.0"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("MPL-2.0", "Mozilla Public License, version 2.0"),
    ("MPL-2.0", "Mozilla Public License, v. 2.0"),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("Unlicense", "SPDX-License-Identifier: Unlicense"),
    *[(f"CC-{kind}-{version}", f"SPDX-License-Identifier: CC-{kind}-{version}") for kind in _CC_KINDS for version in ("1.0", "2.0", "2.5", "3.0", "4.0")],
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
    *[(f"CC-{kind}-{version}", text) for kind in _CC_KINDS for version in ("1.0", "2.0", "2.5", "3.0", "4.0") for text in (f"CC-{kind} {version}", f"under CC-{kind}-{version}")],
    *[("MIT", text) for text in ("MIT License", "License: MIT", "The MIT License", "MIT licensed")],
    *[("Apache-2.0", text) for text in ("Apache License 2.0", "License: Apache-2.0", "License: Apache 2.0", "Apache 2.0 License", "under Apache-2.0")],
    *[(f"BSD-{n}-Clause", text) for n in (2, 3) for text in (f"License: BSD-{n}-Clause", f"{n}-Clause BSD License", f"under BSD-{n}-Clause")],
    *[(f"{short}-{n}.0", form.format(short, n)) for short in ("GPL", "LGPL", "AGPL") for n in (2, 3) if (short, n) not in (("LGPL", 2), ("AGPL", 2)) for form in _GNU_SHORT],
)
_SENTENCE_END = re.compile(r"[.;:!?](?:\s|$)|\n\s*\n")
_WORD = re.compile(r"<>|[^\W_]+(?:[.\-][^\W_]+)*")


def _words(text: str) -> list[str]:
    return [match.group().lower() for match in _WORD.finditer(text)]


def _critical(words: list[str]) -> bool:
    return any(word in CRITICAL or any(c.isdigit() for c in word) for word in words)


class Template:
    def __init__(self, name: str, text: str):
        self.name, self.words, self.blanks = name, [], set()
        for word in _words(text):
            if word == "<>":
                self.blanks.add(len(self.words))
            else:
                self.words.append(word)
        self.needed = frozenset(word for word in self.words if _critical([word]))
        #: Words that a wording may have more than the template.
        self.slack = len(self.words) // TOLERANCE + BLANK_WORDS * len(self.blanks)
        plain = f" {' '.join(self.words)} ".encode()  # the spaces around it let the shortest names save a byte
        self.compressor = zstandard.ZstdCompressor(level=9, dict_data=zstandard.ZstdCompressionDict(plain, dict_type=zstandard.DICT_TYPE_RAWCONTENT))

    def possible(self, words: set[str]) -> bool:
        """Whether a block of these words may hold the wording: what is missing differs."""
        return self.needed <= words and sum(word not in words for word in self.words) * TOLERANCE <= len(self.words)

    def wordings(self, words: list[str]) -> list[tuple[int, int, int]]:
        """(first word, end, differing words) of wordings in ``words``: all that are word for word, or else the nearest."""
        size, found, at = len(self.words), [], 0
        while not self.blanks and at <= len(words) - size:
            try:
                at = words.index(self.words[0], at)
            except ValueError:
                break
            if words[at : at + size] == self.words:
                found.append((at, at + size, 0))
                at += size
            else:
                at += 1
        if found or not self.blanks and size < TOLERANCE:
            return found
        matcher = SequenceMatcher(None, self.words, words, autojunk=False)
        nearest = self.wording(words, matcher.get_opcodes())
        if not nearest:  # its words elsewhere in the block may have drawn it apart: the surroundings of its longest part
            a, b, _ = matcher.find_longest_match()
            low, high = max(0, b - a - self.slack), b - a + size + self.slack
            near = words[low:high]
            if len(near) < len(words):
                nearest = self.wording(near, SequenceMatcher(None, self.words, near, autojunk=False).get_opcodes())
                nearest = nearest and (nearest[0] + low, nearest[1] + low, nearest[2])
        return [nearest] if nearest else []

    def wording(self, words: list[str], steps: list[tuple]) -> tuple[int, int, int] | None:
        """The wording as aligned with ``words``, if it is confirmed."""
        same = [step for step in steps if step[0] == "equal"]
        if not same:
            return None
        differ, first, end = 0, same[0][3], same[-1][4]
        for kind, a, b, c, d in steps:
            if kind == "equal":
                continue
            outside = d <= first or c >= end
            extra = [] if outside else words[c:d]
            if a in self.blanks and len(extra) <= BLANK_WORDS and a == b:
                continue
            if _critical(self.words[a:b]) or _critical(extra):
                return None
            differ += max(b - a, len(extra))
        return (first, end, differ) if differ * TOLERANCE <= len(self.words) else None


@cache
def templates() -> tuple[Template, ...]:
    return tuple(Template(name, text) for name, text in TEMPLATES)


@cache
def _plain() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=9)


def ranked(words: list[str], among: list[int]) -> dict[int, int]:
    """The bytes that each of some templates saves on a block of words."""
    raw = f" {' '.join(words)} ".encode()
    alone = len(_plain().compress(raw))
    return {at: alone - len(templates()[at].compressor.compress(raw)) for at in among}


def confirmed(block: str) -> list[tuple[str, int, int, int, int]]:
    """(license, start, end, differing words, bytes saved) for the wordings found in a block, in code points."""
    spans = [match.span() for match in _WORD.finditer(block)]
    words = [block[start:end].lower() for start, end in spans]
    found: list[tuple] = []
    rest = [(0, len(words))]
    while rest:
        low, high = rest.pop()
        held = words[low:high]
        known = set(held)
        saved = ranked(held, [at for at, template in enumerate(templates()) if template.possible(known)])
        winners = sorted((at for at in saved if saved[at] > 0), key=lambda at: (-saved[at], at))
        for at in winners:
            template = templates()[at]
            taken = sorted(template.wordings(held))
            if taken:
                found += [(low + first, low + end, template.name, differ, saved[at]) for first, end, differ in taken]
                edges = [0, *(edge for first, end, _ in taken for edge in (first, end)), len(held)]
                rest += [(low + first, low + end) for first, end in zip(edges[::2], edges[1::2], strict=True) if first < end]
                break
    stated = [wording for wording in sorted(found) if not _denied(block, spans, words, wording[0])]
    return [(name, spans[first][0], spans[end - 1][1], differ, saved) for first, end, name, differ, saved in stated]


def _denied(block: str, spans: list[tuple[int, int]], words: list[str], first: int) -> bool:
    """Whether one of the few words before a wording, in its sentence, says that it does not hold."""
    for at in range(first - 1, max(-1, first - 1 - DENIAL_WORDS), -1):
        if _SENTENCE_END.search(block, spans[at][1], spans[at + 1][0]):
            return False
        if words[at] in DENIALS:
            return True
    return False


def blocks(text: str) -> list[tuple[int, int]]:
    """Start and end of the candidate blocks: runs of lines first, then single lines, in order."""
    lowered = text.lower()
    if not any(cue in lowered for cue in CUES):
        return []
    lines, at = [], 0
    for line in text.split("\n"):
        lines.append((at, at + len(line)))
        at += len(line) + 1
    cued = [i for i, (start, end) in enumerate(lines) if any(cue in text[start:end].lower() for cue in CUES)]
    runs: list[list[int]] = []
    for i in cued:
        if runs and i - runs[-1][1] <= GAP:
            runs[-1][1] = i
        else:
            runs.append([i, i])
    last = len(lines) - 1
    wide = [(lines[max(0, a - AROUND)][0], lines[min(last, b + AROUND)][1]) for a, b in runs]
    return [part for start, end in wide + [lines[i] for i in cued] for part in _parts(text, start, end)]


def _parts(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """The block, or if it has too many words overlapping parts of it around its cues."""
    spans = [match.span() for match in _WORD.finditer(text, start, end)]
    if len(spans) <= LINE_WORDS:
        return [(start, end)]
    step = LINE_WORDS // 2
    parts = [(spans[at][0], spans[min(at + LINE_WORDS, len(spans)) - 1][1]) for at in range(0, len(spans) - step, step)]
    return [(a, b) for a, b in parts if any(cue in text[a:b].lower() for cue in CUES)]


def scan(text: str, known: dict[str, list]) -> tuple[int, list[tuple]]:
    """Number of candidate blocks, and (start, end, license, differing words, bytes saved) of the wordings found."""
    candidates, found = blocks(text), []
    for start, end in candidates:
        block = text[start:end]
        if block not in known:
            if len(known) >= CACHE_BLOCKS:
                known.clear()
            known[block] = confirmed(block)
        for name, a, b, differ, saved in known[block]:
            span = (start + a, start + b)
            if all(span[1] <= other[0] or other[1] <= span[0] for other in found):
                found.append((*span, name, differ, saved))
    return len(candidates), sorted(found)


def license_report(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, n_blocks, n_found, licenses, findings (license:start:end:differing words:bytes saved)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list] = {}
        for batch in batches:
            rows = [scan(text.as_py() or "", known) for text in batch["text"]]
            columns = [
                pa.array([n for n, _ in rows], pa.int64()),
                pa.array([len(found) for _, found in rows], pa.int64()),
                pa.array([",".join(sorted({f[2] for f in found})) for _, found in rows], pa.string()),
                pa.array([",".join(f"{f[2]}:{f[0]}:{f[1]}:{f[3]}:{f[4]}" for f in found) for _, found in rows], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], names=["doc_id", "n_blocks", "n_found", "licenses", "findings"])

    schema = "doc_id long, n_blocks long, n_found long, licenses string, findings string"
    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
