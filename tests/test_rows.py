import random

from pyspark.sql import functions as F

from docketframe.operators import children, refs, rows
from docketframe.plans import jobs
from docketframe.schema import CASES_DDL, OUTPUT_COLUMNS, ROW_COLUMNS
from docketframe.sources import csv_sink
from workloads import queries


def case(number="N-1", parties=(), events=(), place=(0, 0, 0), county="C"):
    return ("k", county, number, number, "a v. b", "2024-01-01", "Civil", "Open", "Court", list(parties), list(events), *place)


def frame(spark, *cases):
    return spark.createDataFrame(list(cases), CASES_DDL)


def attorney(first, last, middle="", suffix=""):
    return (first, middle, last, suffix)


def table(spark, *cases):
    return jobs.finish(rows.nested_case_rows(frame(spark, *cases)))


def test_fourteen_columns_in_order(spark):
    got = table(spark, case()).columns
    assert got == [
        "County", "Case Number", "Case Name", "Filing Date", "Type", "Status", "Court", "First Name", "Middle Name",
        "Last Name", "Suffix", "Party (Plaintiff/Defendant)", "Events / Hearings", "Events / Hearings (cont.)",
    ]


def test_one_row_per_attorney_and_blank_row_without(spark):
    parties = [
        ("p", "Plaintiff", [attorney("A", "One"), attorney("B", "Two")]),
        ("q", "Defendant", []),
        ("r", "Defendant", [attorney("C", "Three")]),
    ]
    got = table(spark, case(parties=parties), case("N-2", [("q", "Defendant", [])]), case("N-3")).collect()
    names = [(r["Case Number"], r["First Name"], r["Party (Plaintiff/Defendant)"]) for r in got]
    assert names == [
        ("N-1", "A", "Plaintiff"), ("N-1", "C", "Defendant"), ("N-1", "B", "Plaintiff"), ("N-2", "", ""), ("N-3", "", ""),
    ]


def test_events_first_and_others(spark):
    events = [("", "", ""), ("2024-01-01", "x", ""), ("2024-01-02", "y", "R"), ("", "z", "")]
    got = {r["Case Number"]: tuple(r)[-2:] for r in table(spark, case(events=events), case("N-2"), case("N-3", events=events[:2])).collect()}
    assert got == {"N-1": ("2024-01-01 — x", "2024-01-02 — y [R]; z"), "N-2": ("", ""), "N-3": ("2024-01-01 — x", "")}


def test_same_case_twice_and_same_attorney_on_two_parties(spark):
    twice = [("p", "Plaintiff", [attorney("A", "One")]), ("q", "Plaintiff", [attorney("A", "One")])]
    assert table(spark, case(parties=twice), case(parties=twice, place=(0, 1, 0))).count() == 1


def test_null_cells_become_empty(spark):
    row = ("k", None, "N", "N", None, None, None, None, None, [("p", None, [(None, None, "L", None)])], [], 0, 0, 0)
    (got,) = table(spark, row).collect()
    assert None not in tuple(got) and got["Last Name"] == "L"


def test_ties_keep_first_seen_order(spark):
    one = [("p", "Zeta", [attorney("A", "One", "m2"), attorney("A", "One", "m1")]), ("q", "Alpha", [attorney("A", "One", "m3")])]
    other = [("p", "Beta", [attorney("A", "One", "m0")])]
    got = table(spark, case(parties=other, place=(1, 0, 0)), case(parties=one, place=(0, 7, 3)))
    assert [r["Middle Name"] for r in got.collect()] == ["m2", "m1", "m3", "m0"]


def test_sort_is_by_code_point(spark):
    parties = [("p", "P", [attorney("x", n) for n in ("a", "B", "é", "Z", "\U0001f600", "￮")])]
    got = [r["Last Name"] for r in table(spark, case(parties=parties)).collect()]
    assert got == sorted(got) and len(got) == 6


def test_empty_input_gives_the_columns(spark):
    got = table(spark)
    assert got.columns == list(OUTPUT_COLUMNS.values()) and got.count() == 0


def test_csv_layout(spark, tmp_path):
    parties = [("p", 'Plain"tiff', [attorney("A, B", " One ")])]
    path = str(tmp_path / "out")
    back = csv_sink.write_csv(table(spark, case(parties=parties), case("N-2")), path)
    lines = [l for f in sorted((tmp_path / "out").glob("part-*")) for l in f.read_bytes().split(b"\n") if l]
    header = ",".join(OUTPUT_COLUMNS.values()).encode()
    assert header in lines and b'"A, B",,One,,"Plain""tiff",,' in b"\n".join(lines)
    assert b"C,N-2,a v. b,2024-01-01,Civil,Open,Court,,,,,,," in lines
    assert sorted(tuple(r) for r in back.collect()) == sorted(
        tuple(r) for r in table(spark, case(parties=parties), case("N-2")).collect()
    )
    csv_sink.write_csv(table(spark), path)  # replaces; the header is there without rows
    assert [f.read_bytes() for f in (tmp_path / "out").glob("part-*")] == [header + b"\n"]


def test_dedup_is_a_hash_aggregate_with_map_side_combine(spark):
    plan = rows.distinct_rows(rows.nested_case_rows(frame(spark, case())))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and "SortAggregate" not in plan


def test_positions_match_the_sorted_table(spark):
    pick = random.Random(3)
    cases = [
        case(f"N-{pick.randrange(9)}", [("p", str(n), [attorney(pick.choice("ab"), pick.choice("xyz"))])], place=(0, n, 0))
        for n in range(200)
    ]
    distinct = rows.distinct_rows(rows.nested_case_rows(frame(spark, *cases)))
    ordered = [tuple(r) for r in rows.sort_rows(distinct).select(*ROW_COLUMNS).collect()]
    placed = rows.sorted_positions(distinct).orderBy("position").select("position", *ROW_COLUMNS).collect()
    assert [r.position for r in placed] == list(range(len(ordered)))
    assert [tuple(r)[1:] for r in placed] == ordered


def test_first_seen_refs_with_a_reference_on_every_page(spark):
    listed = [("k", "hot", page, 5) for page in range(300, 0, -1)] + [("k", f"r{n}", n, 0) for n in range(150)]
    listed += [("other", "hot", 9, 9), ("k", "hot", 1, 4)]
    got = refs.first_seen(spark.createDataFrame(listed, "county_key string, case_ref string, page_ord int, ref_pos int"))
    first = {}
    for county, ref, page, pos in listed:
        first[county, ref] = min(first.get((county, ref), (page, pos)), (page, pos))
    assert {(r.county_key, r.case_ref): (r.page_ord, r.ref_pos) for r in got.collect()} == first


def test_listing_order_is_exact_at_the_ends(spark):
    top = 2**31 - 1
    listed = [("k", "a", top, top), ("k", "b", 0, 0), ("k", "c", top, 0), ("k", "c", top - 1, top)]
    got = refs.first_seen(spark.createDataFrame(listed, "county_key string, case_ref string, page_ord int, ref_pos int"))
    assert {r.case_ref: (r.page_ord, r.ref_pos) for r in got.collect()} == {
        "a": (top, top), "b": (0, 0), "c": (top - 1, top)
    }
    order = rows.first_seen_order(F.lit(999_999_999), F.lit(top), F.lit(top), F.lit(top)).cast("string")
    assert spark.range(1).select(order).first()[0] == str(999_999_999 * 10**29 + (top << 32 | top) * 10**10 + top)


def test_children_of_a_hot_parent_match_brute_force(spark):
    pick = random.Random(5)
    events = [(0 if n % 3 == 0 else pick.randrange(40), pick.randrange(5000), pick.choice(["", "2024-01-01"]), pick.choice(["", "d", "e"]), "")
              for n in range(6000)]
    df = spark.createDataFrame(events, "parent int, place bigint, date string, description string, location string")
    wanted = {}
    for parent, place, date, description, _ in events:
        line = " — ".join(part for part in (date, description) if part)
        if line:
            wanted.setdefault(parent, []).append((place, line))
    wanted = {k: [line for _, line in sorted(v)] for k, v in wanted.items()}
    for run in (None, "place"):
        got = children.rendered_events(df, ["parent"], "place", run=run).collect()
        assert {r.parent: (r.events_primary, r.events_cont) for r in got} == {
            k: (v[0], "; ".join(v[1:])) for k, v in wanted.items()
        }


def test_positions_are_read_back_by_column(spark):
    cases = [case(f"N-{n % 7}", [("p", "Plaintiff", [attorney("A", f"L{n}")])], [("2024-01-01", "x", "")], place=(0, n, 0)) for n in range(40)]
    placed = rows.sorted_positions(rows.distinct_rows(rows.nested_case_rows(frame(spark, *cases))))
    got = placed.select("position", "case_number", "last_name").orderBy("position").collect()
    assert [tuple(r) for r in got] == [(at, *pair) for at, pair in enumerate(sorted((f"N-{n % 7}", f"L{n}") for n in range(40)))]
    plan = placed.select("position", "case_number")._jdf.queryExecution().executedPlan().toString()
    assert "case_number" in plan and "events_primary" not in plan


def test_events_that_lie_together_give_the_same_cells(spark):
    shape = "parent int, place int, date string, description string, location string"
    data = [(n % 5, n % 4, "" if n % 3 else "2024-01-01", "" if n % 3 else f"d{n % 6}", "") for n in range(60)] + [(9, 0, "", "", "")]
    df = spark.createDataFrame(data, shape)
    apart = children.rendered_events(df, ["parent"], "place")
    together = children.rendered_events(df.repartition("parent"), ["parent"], "place", together=True)
    assert sorted(map(tuple, apart.collect())) == sorted(map(tuple, together.collect())) and apart.count() == 5


def test_parts_are_dealt_to_all_tasks_before_their_pages_are_made(spark, tmp_path):
    spark.createDataFrame([(n,) for n in range(100)], "p_partkey bigint").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    parts = queries._spread_parts(spark, str(tmp_path))
    assert parts.select(F.spark_partition_id().alias("task")).distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(r.p_partkey for r in parts.collect()) == list(range(100))


def test_an_export_starts_from_stored_rows_and_keeps_no_other_shuffle(spark, tmp_path):
    from docketframe.session import SHUFFLE_CLEANUP

    cases = [case(f"N-{at % 7}", [("p", "Plaintiff", [attorney("Ann", f"L{at % 3}")])], place=(0, 0, at)) for at in range(30)]
    made = rows.nested_case_rows(frame(spark, *cases))
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    stored = jobs.finish(made, stored=True)
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == before
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Exchange rangepartitioning" in plan and "HashAggregate" not in plan
    wanted = [tuple(r) for r in jobs.finish(made).collect()]
    assert [tuple(r) for r in stored.collect()] == wanted and len(wanted) == 21
    back = csv_sink.write_csv(stored, str(tmp_path / "csv"))
    assert sorted(map(tuple, back.collect())) == sorted(wanted)
