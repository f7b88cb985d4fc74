import pytest

from docketframe.llm import licenses


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("Licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", ["CC-BY-SA-4.0"]),
        ("This work is licensed under a Creative Commons Attribution-Noncommercial-No Derivative Works 3.0 United States License.", ["CC-BY-NC-ND-3.0"]),
        ("Photos: Creative Commons Attribution-Share Alike 2.5 Generic", ["CC-BY-SA-2.5"]),
        ("available under the Creative Commons Attribution-ShareAlike License; additional terms may apply", ["CC-BY-SA"]),
        ("The text is under CC BY-NC-SA 2.0.", ["CC-BY-NC-SA-2.0"]),
        ("Creative Commons Attribution-Something 4.0 International License", []),
        ("SPDX-License-Identifier: LGPL-2.1-or-later", ["LGPL-2.1"]),
        ("under the GNU Lesser General Public License, version 2.1", ["LGPL-2.1"]),
        ("it is under the GNU Affero General Public License v3", ["AGPL-3.0"]),
        ("GNU Free Documentation License, Version 1.2", ["GFDL-1.2"]),
        ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n\n Copyright (C) 1989, 1991", ["GPL-2.0"]),
        ("                   GNU LESSER GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007", ["LGPL-3.0"]),
        ("                                 Apache License\n                           Version 2.0, January 2004", ["Apache-2.0"]),
        ("Mozilla Public License Version 2.0\n==================================\n\n1. Definitions", ["MPL-2.0"]),
        ("Creative Commons Attribution-NonCommercial 4.0 International Public License", ["CC-BY-NC-4.0"]),
        ("The code is under the MIT license, the text under CC0 1.0 Universal.", ["MIT", "CC0-1.0"]),
        ("the GNU General Public License, version 4", []),
        ("Licensed under GPLv3", ["GPL-3.0"]),
        ("Licensed under CC-BY-SA 4.0", ["CC-BY-SA-4.0"]),
        ("Licensed under the Apache License 2.0", ["Apache-2.0"]),
        ("License: MIT", ["MIT"]),
        ("MIT License\n\nCopyright (c) 2020 Jane Roe", ["MIT"]),
        ("License: BSD-3-Clause", ["BSD-3-Clause"]),
        ("This is not released under the MIT License.", []),
        ("We never were, nor are we now, licensed under GPLv3", []),
        ("It is not mine. Licensed under the MIT License.", ["MIT"]),
    ],
)
def test_names_and_versions(text, found):
    assert [finding[2] for finding in licenses.scan(text, {})[1]] == found


@pytest.mark.parametrize("saving", [0, 7])
def test_the_saved_bytes_decide(monkeypatch, saving):
    """With savings that are all alike nothing, or another wording, is confirmed."""
    texts = ["This work is licensed under CC BY-NC 4.0.", "Licensed under the GNU General Public License, version 2.1 or so", "it is Licensed under the Apache License, Version 2.0 (x)"]
    texts.append(next(text for name, text in licenses.TEMPLATES if name == "BSD-3-Clause" and "<>" in text).replace("<>", "and"))
    plain = [licenses.scan(text, {})[1] for text in texts]
    monkeypatch.setattr(licenses, "ranked", lambda words, among: dict.fromkeys(among, saving))
    alike = [licenses.scan(text, {})[1] for text in texts]
    assert [[f[:3] for f in found] for found in alike] != [[f[:3] for f in found] for found in plain]
    assert saving or not any(alike)


def test_every_wording_saves_bytes_where_it_stands():
    for at, template in enumerate(licenses.templates()):
        for words in (template.words, ["so", "this", *template.words, "is", "all"]):
            assert licenses.ranked(list(words), [at])[at] > 0, template.words


def test_every_wording_is_found_against_plain_alignment():
    """Full alignment of every template, without compression, is the oracle for texts that hold one wording."""
    for at, template in enumerate(licenses.templates()):
        text = "Here is what holds: " + " ".join(word for word in template.words) + " and that is all"
        (found, *more) = licenses.confirmed(text) or [None]
        words = licenses._words(text)
        fitting = [own for own in licenses.templates() if own.possible(set(words)) and own.wordings(words)]
        assert found is not None and not more or template.blanks, template.words
        assert found is None or found[0] in {own.name for own in fitting}
        nearest = min(fitting, key=lambda own: (own.wordings(words)[0][2], -len(own.words)))
        assert found is None or found[0] == nearest.name, template.words


def test_no_wording_stands_for_two_licenses():
    held = {}
    for name, text in licenses.TEMPLATES:
        assert held.setdefault(tuple(licenses._words(text)), name) == name
