import textwrap

import pytest

from docketframe.llm import licenses

LONG = {name: text for name, text in licenses.TEMPLATES if len(text) > 100 and not name.startswith("CC")}


def names(text):
    return [finding[2] for finding in licenses.scan(text, {})[1]]


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("Photos: This work is licensed under CC BY-NC 4.0. Other parts. All rights reserved.", ["CC-BY-NC-4.0", "all-rights-reserved"]),
        (
            "Licensed under the Apache License, Version 2.0. Released under the MIT License. All rights reserved.",
            ["Apache-2.0", "MIT", "all-rights-reserved"],
        ),
        ("All rights reserved. Foo. All rights reserved. Released under the MIT License. All rights reserved.", ["all-rights-reserved"] * 2 + ["MIT", "all-rights-reserved"]),
        (" ".join(f"Licensed under CC {kind} {version}." for kind in ("BY", "BY-SA", "BY-NC", "BY-ND") for version in ("4.0", "3.0") * 2),
         [f"CC-{kind}-{version}" for kind in ("BY", "BY-SA", "BY-NC", "BY-ND") for version in ("4.0", "3.0") * 2]),
    ],
)
def test_many_notices_on_one_line(text, found):
    assert names(text) == found


@pytest.mark.parametrize("width", [60, 10**6])
def test_a_notices_file_with_many_licenses(width):
    order = ["MIT", "BSD-3-Clause", "Apache-2.0", "GPL-3.0", "LGPL-3.0", "MPL-2.0", "ISC"]
    parts = [textwrap.fill(LONG[name].replace("<>", "some owner"), width) for name in order]
    assert names("\n".join(f"Part {i}\n{part}" for i, part in enumerate(parts))) == order
    assert names("\n".join(parts[::-1])) == order[::-1]
    assert names("\n".join(parts * 3)) == order * 3


def test_copies_with_changes_of_their_own():
    text = LONG["MIT"]
    copies = [text.replace("merge", "join"), text.replace("persons", "people"), text]
    assert names(" Next part. ".join(copies)) == ["MIT"] * 3


def test_hundreds_of_notices_on_a_line():
    assert names("foo bar. All rights reserved. " * 600) == ["all-rights-reserved"] * 600
