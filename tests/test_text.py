import datetime
import random
import re

import pytest
from pyspark.sql import functions as F

from docketframe.functions import text as tx
from docketframe.functions import urls


def apply(spark, function, values, kind="string"):
    """``function`` over a column of ``values``, in their order."""
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    found = rows.select("i", function(F.col("v")).alias("out")).collect()
    return [r.out if not hasattr(r.out, "asDict") else tuple(r.out) for r in sorted(found, key=lambda r: r.i)]


SPACES = [chr(c) for c in range(0x110000) if chr(c).isspace()]


def tidy(value):
    return " ".join(value.split())


def test_clean_text_knows_every_space_character(spark):
    values = [f"a{c}{c} b{c}" for c in SPACES] + ["a​b", "﻿x", "", " ", None, "one two"]
    got = apply(spark, tx.clean_text, values)
    assert got == [tidy(v or "") for v in values]
    assert apply(spark, tx.clean_text, got) == got


def test_clean_text_and_stacked_cells_on_random_text(spark):
    pick = random.Random(7)
    values = ["".join(pick.choice(SPACES + [" ", "\n", "\r", "a", "b"]) for _ in range(14)) for _ in range(400)]
    assert apply(spark, tx.clean_text, values) == [tidy(v) for v in values]
    lines = [[tidy(p) for p in re.split("[\r\n]", v) if tidy(p)] for v in values]
    assert apply(spark, tx.split_stacked, values) == [(p[0], " ".join(p[1:])) if p else ("", "") for p in lines]


@pytest.mark.parametrize(
    "value, expected",
    [
        ("04/02/2024\nCourtroom 3A", ("04/02/2024", "Courtroom 3A")),
        ("04/02/2024", ("04/02/2024", "")),
        ("\n\r\n", ("", "")),
        (" a \n\n b  c \r\n d ", ("a", "b c d")),
    ],
)
def test_split_stacked(spark, value, expected):
    assert apply(spark, tx.split_stacked, [value]) == [expected]


def test_normalize_date_accepts_every_day_in_every_form(spark):
    start = datetime.date(1995, 12, 20)
    days = [start + datetime.timedelta(days=13 * n) for n in range(300)]
    values, expected = [], []
    for day in days:
        month, short = day.strftime("%B"), day.strftime("%b")
        forms = [
            f"{day.month:02}/{day.day:02}/{day.year}",
            f"{day.month}-{day.day}-{day.year}",
            f"{day.month}/{day.day}/{day.year % 100:02}",
            f"{day.year}-{day.month}-{day.day:02}",
            f"{month.upper()}  {day.day}, {day.year}",
            f" {short.lower()} {day.day}, {day.year}",
            f"{day.day:02} {short} {day.year}",
        ]
        values += forms
        expected += [day.isoformat()] * len(forms)
    assert apply(spark, tx.normalize_date, values) == expected
    assert apply(spark, tx.normalize_date, expected) == expected


@pytest.mark.parametrize(
    "value, expected",
    [
        ("1/2/69", "1969-01-02"),
        ("1/2/68", "2068-01-02"),
        ("0001/02/03", "0001/02/03"),
        ("13/1/2024", "13/1/2024"),
        ("Feb 30, 2024", "Feb 30, 2024"),
        ("02/29/2023", "02/29/2023"),
        ("02/29/2024", "2024-02-29"),
        ("0000-01-01", "0000-01-01"),
        ("9 January 2024", "9 January 2024"),
        ("January 9,2024", "January 9,2024"),
        ("2024-January-9", "2024-January-9"),
        ("2024-01-05 10:00", "2024-01-05 10:00"),
        ("Sept 9, 2024", "Sept 9, 2024"),
        ("01/ 5/2024", "2024-01-05"),
        ("1/2-2024", "1/2-2024"),
        ("  to be   set ", "to be set"),
        ("", ""),
        (None, ""),
    ],
)
def test_normalize_date_edges(spark, value, expected):
    assert apply(spark, tx.normalize_date, [value]) == [expected]


NAMES = {
    "Smith, John Q. Jr.": ("John", "Q.", "Smith", "Jr."),
    "Daniel O'Sullivan III": ("Daniel", "", "O'Sullivan", "III"),
    "Kim, Soo-Jin": ("Soo-Jin", "", "Kim", ""),
    "Smith, John Q., Jr.": ("John", "Q.", "Smith", "Jr."),
    "Smith, Jr.": ("", "", "Smith", "Jr."),
    "Smith Jr., John": ("John", "", "Smith Jr.", ""),
    "John Jr Smith": ("John", "", "Smith", "Jr."),
    "V Smith": ("", "", "Smith", "V"),
    "Jr.": ("", "", "Jr.", ""),
    "John Q Jr Esq": ("John", "Q", "Jr", "Esq."),
    "De La Cruz, Maria": ("Maria", "", "De La Cruz", ""),
    "Maria De La Cruz": ("Maria", "De La", "Cruz", ""),
    "Smith, John,": ("John,", "", "Smith", ""),
    ", Jr.": ("", "", "", "Jr."),
    ",": ("", "", "", ""),
    ", ,": (",", "", "", ""),
    "Lee, A, B, J.R.": ("A,", "B", "Lee", "Jr."),
    "Smith,Jr,Sr": ("Jr", "", "Smith", "Sr."),
    "Jr Sr Esq": ("Jr", "", "Sr", "Esq."),
    "  Ann \t Lee iv. ": ("Ann", "", "Lee", "IV"),
    "": ("", "", "", ""),
    None: ("", "", "", ""),
}


def test_split_name(spark):
    assert dict(zip(NAMES, apply(spark, tx.split_name, list(NAMES)))) == NAMES


def test_norm_suffix(spark):
    values = {"jr": "Jr.", "SR.": "Sr.", "e.s.q": "Esq.", "ii": "II", "V.": "V", "vi": "", "": "", None: "", "jr ": ""}
    assert dict(zip(values, apply(spark, tx.norm_suffix, list(values)))) == values


def test_placeholders(spark):
    values = {
        "Pro Se": True, " PRO SE. ": True, "N.A.": True, "n/a": True, "": True, None: True, "None": True,
        "not  represented": True, "Pro Se Smith": False, ",": False, ".,": False, "No Attorneys": False,
    }
    assert dict(zip(values, apply(spark, tx.is_placeholder, list(values)))) == values
    nobody = {**values, ",": True}
    assert dict(zip(nobody, apply(spark, tx.names_nobody, list(nobody)))) == nobody


def test_format_event(spark):
    events = {
        ("2024-01-01", "Trial — Jury", "Room 1"): "2024-01-01 — Trial — Jury [Room 1]",
        ("", "Trial", ""): "Trial",
        ("2024-01-01", "", ""): "2024-01-01",
        ("", "", ""): "",
        ("", "", "Room"): "[Room]",
        (" — ", "x —", ""): "x",
    }
    got = apply(spark, tx.format_event, list(events), "struct<date:string,description:string,location:string>")
    assert dict(zip(events, got)) == events


def test_label_key_strips_colons_only(spark):
    assert apply(spark, tx.label_key, ["Status:", "Status :", " Date  Filed:: "]) == ["status", "status ", "date filed"]


def test_zero_pad(spark):
    pairs = [(5, 6), (-5, 6), (1234567, 6), (0, 1), (-12, 2), (7, 0)]
    rows = spark.createDataFrame(pairs, "n bigint, w int").select(tx.zero_pad(F.col("n"), F.col("w"))).collect()
    assert [r[0] for r in rows] == [str(n).zfill(w) for n, w in pairs]


def test_page_key(spark):
    keys = {
        "https://h.invalid/x/Search/results_1": "results_1.html",
        "https://h.invalid/x/Case/A 1#part": "A 1.html",
        "https://h.invalid/a/b.html?x=1/2": "b.html",
        "https://h.invalid": "index.html",
        "https://h.invalid/": "index.html",
        "https://h.invalid/a/": "a.html",
        "https://h.invalid/a;p=1": "a.html",
        "./Case/D-1": "D-1.html",
    }
    assert dict(zip(keys, apply(spark, urls.page_key, list(keys)))) == keys


def test_a_stacked_line_needs_no_further_cleaning(spark):
    signs = [" ", "\n", "\r\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", " ", " ", "​", "　", "1/2/2020", "Jan 5, 2021", "31 DEC 1999", "x", "é"]
    pick = random.Random(6)
    cells = spark.createDataFrame([("".join(pick.choices(signs, k=at % 9)),) for at in range(3000)], "cell string")
    lines = cells.select("cell", tx.split_stacked(F.col("cell")).alias("parts")).select("cell", "parts.date", "parts.location")
    for part in ("date", "location"):
        assert lines.where(tx.clean_text(F.col(part)) != F.col(part)).count() == 0
    assert lines.where(~tx.normalize_clean_date(F.col("date")).eqNullSafe(tx.normalize_date(F.col("date")))).count() == 0
    whole = F.concat_ws(" ", F.filter(F.array("date", "location"), lambda part: part != ""))
    assert lines.where(whole != tx.clean_text(F.col("cell"))).count() == 0
