import random

import pytest

from docketframe.operators import numbers
from docketframe.plans import jobs
from docketframe.sources.config import load_counties
from tests import sample


def listed(spark, *specs):
    county = {"key": "k", "sequences": specs}
    found = jobs.candidate_numbers(numbers.specs_frame(spark, [county]))
    return [r.case_number for r in found.orderBy("ordinal").collect()]


def test_plain_is_padded_and_inclusive(spark):
    spec = {"pattern": "plain", "template": "{bench}.{seq}/{suffix}x", "start": 98, "end": 100, "width": 3, "extra": {"bench": "QB"}}
    assert listed(spark, spec) == ["QB.098/x", "QB.099/x", "QB.100/x"]


def test_wide_numbers_are_never_cut(spark):
    assert listed(spark, {"pattern": "plain", "template": "{seq}", "start": 98, "end": 101, "width": 2}) == ["98", "99", "100", "101"]


def test_letter_suffix_is_grouped_by_number(spark):
    spec = {"pattern": "letter_suffix", "template": "{seq}{suffix}", "start": 1, "end": 2, "width": 2, "suffixes": ["B", "A"]}
    assert listed(spark, spec) == ["01B", "01A", "02B", "02A"]


def test_default_suffixes_and_width(spark):
    got = listed(spark, {"pattern": "letter_suffix", "template": "{seq}{suffix}", "suffixes": []})
    assert got == [f"000001{letter}" for letter in "ABCDEFGH"]


def test_per_suffix_ranges_follow_the_alphabet(spark):
    spec = {
        "pattern": "per_suffix", "template": "{seq}{suffix}", "width": 1, "suffixes": ["Z", "M", "A"],
        "per_suffix_ranges": {"A": {"start": 5, "end": 6}, "Z": {"start": 1, "end": 2}, "Q": {"start": 1, "end": 1}},
    }
    assert listed(spark, spec) == ["1Z", "2Z", "5A", "6A"]


def test_overlapping_specs_keep_the_first(spark):
    one = {"pattern": "plain", "template": "{seq}", "start": 3, "end": 5, "width": 1}
    two = {"pattern": "plain", "template": "{seq}", "start": 1, "end": 6, "width": 1}
    assert listed(spark, one, two) == ["3", "4", "5", "1", "2", "6"]


def test_template_constants_and_braces(spark):
    spec = {"pattern": "plain", "template": "{{{a}}}-{seq}-{seq}", "width": 1, "extra": {"a": "{seq}", "b": "unused"}}
    assert listed(spark, spec) == ["{{seq}}-1-1"]


@pytest.mark.parametrize(
    "spec, problem",
    [
        ({"pattern": "zigzag", "template": "x"}, "no such pattern: 'zigzag'"),
        ({"pattern": "plain", "template": "x", "start": 5, "end": 4}, "range runs backwards: 5 to 4"),
        ({"pattern": "per_suffix", "template": "x"}, "no range for any suffix"),
        ({"pattern": "per_suffix", "template": "x", "per_suffix_ranges": {"A": {"start": 2, "end": 1}}}, "suffix A runs backwards: 2 to 1"),
        ({"pattern": "plain", "template": "{month}-{seq}"}, "without a value: .month"),
        ({"pattern": "plain", "template": None}, "template is missing"),
        ({"pattern": "plain", "template": "{seq}", "extra": {"seq": "1"}}, "redefines"),
    ],
)
def test_invalid_specs_stop_the_job(spark, spec, problem):
    with pytest.raises(Exception, match=problem):
        listed(spark, spec)


def test_no_specs_no_numbers(spark):
    assert listed(spark) == []


def test_configured_counties(spark):
    got = jobs.candidate_listing(spark, sample.COUNTIES).collect()
    assert [(r.county, r.candidates) for r in got] == [("Juniper County", 12)] * 12 + [("Sorrel County", 12)] * 12
    assert [r.case_number for r in got[:2]] == ["JN00041-19", "JN00042-19"]
    assert [r.case_number for r in got[12:15]] == ["SR-012-X", "SR-012-Y", "SR-013-X"]
    assert [r.case_number for r in got[-6:]] == [f"SP-00{n}-K" for n in range(30, 35)] + ["SP-0008-M"]


def test_one_huge_range_is_split_and_whole(spark):
    spec = {"pattern": "plain", "template": "{seq}", "start": 5, "end": 300_004, "width": 1}
    frame = numbers.specs_frame(spark, [{"key": "k", "sequences": [spec]}])
    found = numbers.expand(numbers.runs(frame), chunk=1000)
    row = found.selectExpr("count(*) n", "min(ordinal) a", "max(ordinal) b", "count(distinct case_number) d").first()
    assert tuple(row) == (300_000, 0, 299_999, 300_000)


def test_random_specs_match_brute_force(spark):
    pick = random.Random(11)
    specs, wanted, seen = [], [], set()
    for _ in range(25):
        start = pick.randrange(20)
        spec = {
            "pattern": pick.choice(numbers.PATTERNS), "template": "{seq}{suffix}", "width": pick.randrange(1, 4),
            "start": start, "end": start + pick.randrange(9), "suffixes": pick.sample("ABCD", 3),
            "per_suffix_ranges": {s: {"start": start, "end": start + pick.randrange(5)} for s in pick.sample("ABCDE", 2)},
        }
        specs.append(spec)
        span = range(spec["start"], spec["end"] + 1)
        if spec["pattern"] == "plain":
            pairs = [(n, "") for n in span]
        elif spec["pattern"] == "letter_suffix":
            pairs = [(n, s) for n in span for s in spec["suffixes"]]
        else:
            own = spec["per_suffix_ranges"]
            pairs = [(n, s) for s in spec["suffixes"] if s in own for n in range(own[s]["start"], own[s]["end"] + 1)]
        for n, s in pairs:
            number = str(n).zfill(spec["width"]) + s
            if number not in seen:
                seen.add(number)
                wanted.append(number)
    assert listed(spark, *specs) == wanted


def test_missing_configuration_keys():
    with pytest.raises(ValueError, match="adapter"):
        load_counties([{"key": "k", "county": "C", "base_url": "u", "selectors": {}, "sequences": []}])
    with pytest.raises(ValueError, match="lists no county"):
        load_counties([])


@pytest.mark.parametrize("place", [0, 2**23 + 1, 2**31 + 5, 2**62])
def test_specs_of_any_place(spark, place):
    specs = numbers.specs_frame(spark, [{"key": "k", "sequences": [{"pattern": "plain", "template": "{seq}", "start": 1, "end": 3}]}])
    from pyspark.sql import functions as F

    found = jobs.candidate_numbers(specs.withColumn("spec_ord", F.lit(place)))
    assert sorted(int(r.ordinal) for r in found.collect()) == [place * 10**19 + i for i in range(3)]


def test_long_ranges_are_no_error(spark):
    spec = {"pattern": "letter_suffix", "template": "{seq}", "start": 0, "end": 2**45}
    assert numbers.spec_errors(numbers.specs_frame(spark, [{"key": "k", "sequences": [spec]}])).first().problem is None


def test_gaps_against_brute_force(spark):
    rng = random.Random(7)
    ranges = [("a", 3, 60), ("a", 40, 90), ("b", 5, 4), ("b", None, 3), (None, 1, 9), ("c", 10, 29), ("d", 0, 0)]
    listed_now = [(rng.choice("abce"), rng.randrange(0, 110)) for _ in range(150)] + [("a", None), (None, 4), ("c", 10), ("c", 10)]
    wanted = {(k, i) for k, lo, hi in ranges if k and lo is not None for i in range(lo, hi + 1)}
    there = {(k, i) for k, i in listed_now if k and i is not None}
    expected = set()
    for side, numbers_of in (("missing", wanted - there), ("unexpected", there - wanted)):
        for k, i in numbers_of:
            if (k, i - 1) not in numbers_of:
                last = i
                while (k, last + 1) in numbers_of:
                    last += 1
                expected.add((k, side, i, last, last - i + 1))
    found = numbers.number_gaps(
        spark.createDataFrame(ranges, "county_key string, lo long, hi long"), spark.createDataFrame(listed_now, "county_key string, seq long"), chunk=10
    )
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == expected


def test_gaps_of_long_ranges_make_no_row_per_number(spark):
    """Ends of ranges move, not the numbers in them; below zero and over the edges of chunks too."""
    ranges = spark.createDataFrame([("a", -25, 10**11), ("a", 10**11 + 1, 10**11 + 5)], "county_key string, lo long, hi long")
    listed = spark.createDataFrame([("a", n) for n in (-31, -11, -10, 0, 7, 7, 9999, 10**11 + 6)] + [("b", -10), ("b", -9)], "county_key string, seq long")
    got = sorted(tuple(r) for r in numbers.number_gaps(ranges, listed, chunk=10**8).collect())
    assert got == [
        ("a", "missing", -25, -12, 14), ("a", "missing", -9, -1, 9), ("a", "missing", 1, 6, 6), ("a", "missing", 8, 9998, 9991),
        ("a", "missing", 10**4, 10**11 + 5, 10**11 + 5 - 10**4 + 1), ("a", "unexpected", -31, -31, 1),
        ("a", "unexpected", 10**11 + 6, 10**11 + 6, 1), ("b", "unexpected", -10, -9, 2),
    ]
