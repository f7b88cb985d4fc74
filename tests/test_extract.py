import json
import tracemalloc
from random import Random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docketframe.functions import html as markup
from docketframe.operators import extract, rows
from docketframe.sources.config import load_counties
from tests import sample

COUNTIES = load_counties(sample.COUNTIES)


def find(spark, html, selector, joint=""):
    page = spark.createDataFrame([(html, markup.question([([selector], [])]))], "html string, asked string")
    (elements,) = page.select(markup.select("html", "asked").alias("found")).first().found
    return [element.text.replace(markup.GAP, joint) for element in elements]


@pytest.mark.parametrize(
    "html, selector, expected",
    [
        ("<ul><li>a<li>b</ul><li>c", "li", ["a", "b", "c"]),
        ("<table><tr><td>1<td>2<tr><td>3</table>", "tr", ["12", "3"]),
        ("<dl><dt>a<dd>b<dt>c</dl>", "dt, dd", ["a", "b", "c"]),
        ("<p>a<p>b", "p", ["a", "b"]),
        ("<div class='x y'>a</div><div class=xy>b</div>", "div.x.y", ["a"]),
        ("<a data-k>1</a><a>2</a><a DATA-K='v'>3</a>", "a[data-k]", ["1", "3"]),
        ("<a data-k>1</a><a data-k='v'>3</a>", "a[data-k=v]", ["3"]),
        ("<div id=o><div><b>in</b></div></div><b>out</b>", "#o b", ["in"]),
        ("<td>a<table><tr><td>b</td></tr></table></td>", "td td", ["b"]),
        ("<script>'<b>x</b>'</script><b>y&lt;&eacute;</b>", "b", ["y<é"]),
        ("<!-- <b>x</b> --><b title='a>b'>y</b>", "b", ["y"]),
        ("<b>one<script>no</script> two</b>", "b", ["one two"]),
        ("<div><span>x</div></span>y</div>", "div", ["x"]),
        ("a < b <b>c", "b", ["c"]),
        ("", "b", []),
        ("<B CLASS=k>c</B><br/><i/>d", ".k", ["c"]),
        ("<div>1<div>2</div>3</div><div>4", "div", ["123", "2", "4"]),
        ("<b>&#233;&#x41;&amp;amp; &bogus; & &#0;</b>", "b", ["éA&amp; &bogus; & \ufffd"]),
        ("<div class=\"a\" title=\"it's\" id='q'>z</div>", "div.a#q", ["z"]),
        ("<tr><td>x</td></tr><tr class='k'><td>y</td></tr>", "tr.k td", ["y"]),
        ("<h2>a</h2><p>b<i>c</i></p><i>d</i>", "p i, h2, i", ["a", "c", "d"]),
        ("<ul><li><b>1</b><ul><li><b>2</b></ul></ul><b>3</b>", "li b", ["1", "2"]),
        ("<div><div><b>1</b></div><b>2</b></div>", "div div b", ["1"]),
        ("<p>a<div>b</div></p>c", "p", ["a"]),
        ("<table><tr><td><div>x</td></div><td>y</table><td>z", "td", ["x", "y", "z"]),
        ("<table><tr><td><table><tr><td>in</table></div>out</table>", "tr", ["inout", "in"]),
        ("<a href='x<b>y'>l</a><b>m</b>", "b", ["m"]),
        ("<b title=it's>x</b> and 'y' <i>z</i>", "i", ["z"]),
        ("<b>a < c < d</b><b <i>e", "b", ["a < c < d", "e"]),
        ("<img class=k>t<br>u", ".k", [""]),
        ("<i>a</i><b x='1' y=\"2\" z>b</b>", "[x='1'][y=2][z]", ["b"]),
    ],
)
def test_selectors(spark, html, selector, expected):
    assert find(spark, html, selector) == expected


def test_text_nodes(spark):
    page = "<td>a<br>b <i>c</i> d<!-- -->e</td>"
    assert find(spark, page, "td", "\n") == ["a\nb \nc\n d\ne"]
    assert find(spark, page, "td") == ["ab c de"]


@pytest.mark.parametrize("selector", ["a > b", "a:first-child", "", "a,,b", "a,"])
def test_unsupported_selectors_fail_on_the_driver(selector):
    with pytest.raises(ValueError):
        markup.compile_selector(selector)


def test_refs_with_place(spark):
    refs = extract.extract_refs(sample.pages_frame(spark).where("page_key like 'results%'"), COUNTIES)
    got = [tuple(r) for r in refs.orderBy("county_key", "page_key", "ref_pos").collect()]
    assert got == [
        ("juniper", "results_1.html", 0, "JN00041-19"),
        ("juniper", "results_1.html", 2, "JN00043-19"),
        ("juniper", "results_1.html", 3, "JN00042-19"),
        ("juniper", "results_1.html", 4, "JN00043-19"),
        ("juniper", "results_1.html", 5, "JN00050-19"),
        ("juniper", "results_1.html", 6, "JN00044-19"),
        ("sorrel", "results_1.html", 0, "SR-012-X"),
        ("sorrel", "results_1.html", 1, "SP-0030-K"),
        ("sorrel", "results_1.html", 2, "SR-012-X"),
        ("sorrel", "results_2.html", 0, "SR-013-Y"),
        ("sorrel", "results_2.html", 1, "SR-012-X"),
    ]


@pytest.fixture(scope="module")
def cases(spark):
    found = extract.extract_cases(sample.pages_frame(spark), COUNTIES)
    return {(r.county_key, r.page_key): r for r in found.collect()}


def test_header_last_label_wins_and_aliases(cases):
    first = cases["juniper", "JN00041-19.html"]
    assert (first.case_number, first.case_name, first.status) == ("JN00041-19", "Petra & Sons against Quill", "Reopened")
    second = cases["juniper", "JN00042-19.html"]
    assert (second.case_name, second.filing_date, second.case_type) == ("Matter of Wim", "2018-07-19", "Name change")
    assert second.court is None


def test_page_without_header_is_still_a_case(cases):
    empty = cases["juniper", "JN00044-19.html"]
    assert (empty.case_number, empty.case_name, empty.parties, empty.events, empty.error) == (None, "", [], [], None)


def test_empty_number_attribute_falls_back(cases):
    assert cases["sorrel", "SP-0030-K.html"].case_number is None


def test_short_rows_are_left_out(cases):
    assert [p.name for p in cases["juniper", "JN00042-19.html"].parties] == ["Wim", "Nobody"]
    assert len(cases["juniper", "JN00041-19.html"].events) == 1


def test_stacked_events_and_locations(cases):
    grid = cases["juniper", "JN00043-19.html"].events
    assert [tuple(e) for e in grid] == [
        ("2019-10-30", "Call", "Annex 2"),
        ("2019-11-06", "Second Call", "Annex 2"),
        ("no date yet", "Trial — Bench", ""),
    ]
    block = cases["sorrel", "SP-0030-K.html"].events
    assert tuple(block[0]) == ("2021-08-20", "Interview", "Chamber C, East")


def test_definition_pairs_stop_at_the_shorter_list(spark):
    html = "<div class=case-detail data-case-number=X><dl class=case-meta><dt>Status<dd>Open<dt>Court</dl></div>"
    pages = spark.createDataFrame([("sorrel", "X.html", html)], "county_key string, page_key string, html string")
    (case,) = extract.extract_cases(pages, COUNTIES).collect()
    assert (case.case_number, case.status, case.court) == ("X", "Open", None)


def test_present_but_empty_alias_is_kept(spark):
    html = sample.grid_page([("Style", ""), ("Case Name", "other")], [], [])
    pages = spark.createDataFrame([("juniper", "X.html", html)], "county_key string, page_key string, html string")
    assert extract.extract_cases(pages, COUNTIES).first().case_name == ""


def test_own_selectors(spark):
    county = {**sample.GRID, "selectors": {"header_row": "table.h tr", "search_result_link": "a"}, "county_ord": 0}
    html = "<table class=h><tr><th>Status<td class=value>Open</table><a>one</a>"
    pages = spark.createDataFrame([("juniper", "X.html", html)], "county_key string, page_key string, html string")
    assert extract.extract_cases(pages, [county]).first().status == "Open"
    assert extract.extract_refs(pages, [county]).first().case_ref == "one"


def test_unknown_layout_is_an_error_before_the_job(spark):
    with pytest.raises(KeyError, match="unknown adapter 'nope'.*js_portal"):
        extract.extract_refs(sample.pages_frame(spark), [{**sample.GRID, "adapter": "nope"}])


def test_register_layout_replaces(spark):
    layout = extract.Layout(
        refs=lambda pages, counties: pages.select(
            "county_key", "page_key", F.lit(0).alias("ref_pos"), F.lit("fixed").alias("case_ref")
        ),
        cases=extract.styled_cases,
        style=extract.GRID,
    )
    extract.register_layout("mine", extract.LAYOUTS["js_portal"])
    extract.register_layout("mine", layout)
    try:
        found = extract.extract_refs(sample.pages_frame(spark), [{**sample.GRID, "adapter": "mine"}])
        assert {r.case_ref for r in found.collect()} == {"fixed"}
    finally:
        del extract.LAYOUTS["mine"]


def test_failed_page_is_a_row_with_error(spark):
    pages = spark.createDataFrame(
        [("juniper", "a.html", None), ("juniper", "b.html", "<p>")], "county_key string, page_key string, html string"
    )
    errors = {r.page_key: r.error for r in extract.extract_cases(pages, COUNTIES).collect()}
    assert errors["b.html"] is None and "no content" in errors["a.html"]


def test_nested_model_gives_the_same_rows(spark):
    from docketframe.plans import jobs

    found = jobs.cases_from_pages(sample.pages_frame(spark), sample.COUNTIES)
    nested = rows.nested_cases(found)
    attorney = nested.schema["parties"].dataType.elementType["attorneys"].dataType.elementType
    assert attorney.names == ["first_name", "middle_name", "last_name", "suffix"]
    assert [tuple(r) for r in jobs.finish(rows.nested_case_rows(nested)).collect()] == sample.EXPECTED


def test_faults_by_kind(spark):
    rows = [
        ("juniper", "a", None), ("juniper", "b", "<p>"), ("juniper", "c", "<html><td class=label>x"), ("juniper", "d", "<p>\ufffd"),
        ("juniper", "e", sample.grid_page([("Style", "x")], [], [])), ("juniper", "f", "<table id=grdEvents><tr class=event-row><td>x</table>"),
        ("sorrel", "g", "<div class=case-detail>x</div>"), ("sorrel", "h", "<div class=case-detail>x</div><di"), ("sorrel", "i", ""),
    ]
    pages = spark.createDataFrame(rows, "county_key string, page_key string, html string")
    faults = {r.page_key: r.fault for r in extract.page_faults(pages, COUNTIES).collect()}
    assert faults == {
        "a": "empty", "b": "no root", "c": "truncated", "d": "undecodable", "e": None, "f": "short rows", "g": None, "h": "truncated", "i": "no root"
    }
    listed = {r.page_key: r.fault for r in extract.page_faults(sample.pages_frame(spark).where("page_key like 'results%'"), COUNTIES, "search").collect()}
    assert set(listed.values()) <= {None, "no references"} and None in listed.values()


def many_counties(n):
    return [{**sample.GRID, "key": f"k{i}", "county_ord": i, "selectors": {"header_row": f"#h{i} tr"}} for i in range(n)]


def test_counties_with_selectors_of_their_own_do_not_grow_the_plan(spark):
    pages = spark.createDataFrame(
        [(f"k{i}", "x", f"<table id=h{i}><tr><th>Status<td class=value>s{i}</table>") for i in (0, 7, 4999)], "county_key string, page_key string, html string"
    )
    few, many = (extract.extract_cases(pages, many_counties(n)) for n in (5, 5000))
    assert {r.county_key: r.status for r in many.collect()} == {"k0": "s0", "k7": "s7", "k4999": "s4999"}
    size = lambda df: len(df._jdf.queryExecution().optimizedPlan().toString())
    assert size(many) < size(few) + 2000


def test_reading_takes_time_in_proportion_to_the_page():
    import time

    def seconds(n):
        block = "<div class=party data-role=P><div>x</div><span class=party-name>n<ul class=attorneys><li>A B<li>C D</ul></div>"
        asked = [(markup.compile_selector("section div.party"), [markup.compile_selector("span"), markup.compile_selector("ul li")])]
        page = f"<section>{block * n}</section>"
        start = time.perf_counter()
        assert len(markup.read_elements(page, asked)[0]) == n
        return time.perf_counter() - start

    seconds(200)
    assert min(seconds(6400) for _ in range(3)) < 6 * min(seconds(1600) for _ in range(3))


def test_places_of_element_ends():
    names = ["", "table", "tr", "td", "br", "/b", "td", "table", "tr", "td", "/table", "/td", "/table", "p", "div", "/p", "/div"]
    assert markup.element_stops(names) == [-1, 12, 12, 6, 4, -1, 11, 10, 10, 10, -1, -1, -1, 14, 16, -1, -1]


def test_extraction_from_sql_gives_what_the_calls_give(spark):
    extract.register_table_functions(spark, COUNTIES)
    pages = sample.pages_frame(spark)
    adapters = {c["adapter"]: c["key"] for c in COUNTIES}
    for adapter, key in adapters.items():
        listed = spark.sql(
            "SELECT p.county_key, p.page_key, r.ref_pos, r.case_ref FROM {pages} p JOIN county_questions c USING (county_key),"
            f" LATERAL {adapter}_refs(p.html, c.refs_question) r WHERE p.page_key LIKE 'results%' AND county_key = '{key}'", pages=pages,
        )
        wanted = extract.extract_refs(pages.where(f"page_key like 'results%' and county_key = '{key}'"), COUNTIES)
        assert sorted(map(tuple, listed.collect())) == sorted(map(tuple, wanted.collect()))
        cases = spark.sql(
            "SELECT p.page_key, size(r.parties) AS parties, size(r.events) AS events FROM {pages} p JOIN county_questions c USING (county_key),"
            f" LATERAL {adapter}_case(p.html, c.case_question, c.role_attribute) r WHERE county_key = '{key}'", pages=pages,
        )
        wanted = extract.extract_cases(pages.where(f"county_key = '{key}'"), COUNTIES).selectExpr("page_key", "size(parties)", "size(events)")
        assert sorted(map(tuple, cases.collect())) == sorted(map(tuple, wanted.collect()))


def test_a_batch_of_pages_is_read_in_portions():
    page = "<table id=grdCases>" + '<tr><td><a class="case-link" href="#">C-1</a></td></tr>' * 100 + "</table>"
    asked = markup.question([(["table#grdCases a.case-link"], [])])
    peaks = []
    for n in (500, 2000):
        html, question = pa.array([page, None, *[page] * (n - 2)]), pa.array([asked] * n)
        tracemalloc.start()
        found = markup.select.func(html, question)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert len(found) == n and found[1].as_py() is None and len(found[n - 1].as_py()[0]) == 100
    assert peaks[1] < 1.5 * peaks[0]


def test_portions_of_odd_batches():
    asked = markup.question([(["td"], ["b", "i u"])])
    pages = ["", None, "<td><b>x</b>", "<td>" * 3 + "x" * (1 << 20), "<td><i><u>y</u></i><u>z</u>"] * 2
    found = markup.select.func(pa.array(pages), pa.array([asked] * 9 + [None])).to_pylist()
    assert [None if page is None else len(page[0]) for page in found] == [0, None, 1, 3, 1, 0, None, 1, 3, None]
    assert found[2][0][0]["parts"] == [["x"], []] and found[4][0][0]["parts"] == [[], ["y"]]
    assert markup.select.func(pa.array([], pa.string()), pa.array([], pa.string())).to_pylist() == []


SELECTORS = [["div"], ["section div.party"], ["table#g tr"], ["td.a, th"], ["div div"], ["[k]"], ["div.party, td.a span"], ["[k=1] li"], ["ul", "li"], ["br"], ["*"]]
PARTS = ["span", "ul li", "td, th", "div div span, li", "td.a", "br", "div ul li"]


def random_page(random, sound):
    """Markup whose end tags all stand where they should, or any heap of tags."""
    starts = ["div", "div class=party k=1", "section", "table id=g", "tr", "td class='a b'", "td", "th", "ul", "li k='2'", "span", "p", "b", 'a href="x>y"']
    texts = ["", " ", "x", "a &amp; b", "&#65;", "1 < 2", "<!-- <td> -->", "<script>if (a<b) '<td>'</script>", "<br>", "<hr k=1>", "<!x>"]
    html, opened = [random.choice(texts)], []
    for _ in range(random.randrange(60)):
        if opened and random.random() < 0.45:
            html.append(f"</{opened.pop()}>")
        else:
            start = random.choice(starts)
            html.append(f"<{start}>")
            opened.append(start.split()[0])
        if not sound and random.random() < 0.1:
            html.append(random.choice(["</td>", "</p>", "<td>", "<li>", "</div", "</DIV >", "<p", "</br>"]))
        html.append(random.choice(texts))
    return "".join(html + [f"</{name}>" for name in reversed(opened) if sound])


@pytest.mark.parametrize("sound", [True, False])
def test_pages_looked_up_together_hold_what_each_holds(sound):
    random = Random(4)
    asked = [([*chosen], random.sample(PARTS, random.randrange(4))) for chosen in SELECTORS]
    question = markup.question(asked)
    pages = [random_page(random, sound or at % 3 > 0) for at in range(400)]
    together = markup.select.func(pa.array([None, *pages]), pa.array([question] * 401))
    alone = [markup.read_elements(page, json.loads(question)) for page in pages]
    assert together.equals(markup._columns([None, *alone]))
    assert 20 < markup.Tags(pages).sound.sum() < 400


def test_few_of_many_questions_and_pages_in_turn():
    questions = [markup.question([([name], ["b"])]) for name in ("td", "tr", "td", "p")]
    pages = [f"<table><tr><td>{at}<b>x{at}</b></td></tr></table>" for at in range(60)]
    pages[7], pages[11], pages[20] = None, "", "<td><b>y"
    asked = [questions[at % 4] if at % 5 else questions[1] for at in range(60)]
    asked[31] = None
    wanted = [None if page is None or own is None else markup.read_elements(page, json.loads(own)) for page, own in zip(pages, asked)]
    assert markup.select.func(pa.array(pages), pa.array(asked)).equals(markup._columns(wanted))


def test_pages_asked_the_same_take_less_time_together():
    import time

    page = '<div class="case-detail"><dl><dt>Filed</dt><dd>x &amp; y</dd></dl>' + '<div class="event"><span class="d">1</span><span class="l">2</span></div>' * 12 + "</div>"
    asked = [(["div.event"], ["span.d", "span.l"]), (["div.case-detail", "dl"], ["dt", "dd"])]
    question = markup.question(asked)
    html, questions = pa.array([page] * 2000), pa.array([question] * 2000)

    def seconds(run):
        start = time.perf_counter()
        run()
        return time.perf_counter() - start

    alone = min(seconds(lambda: markup._columns([markup.read_elements(page, json.loads(question)) for _ in range(2000)])) for _ in range(3))
    assert min(seconds(lambda: markup.select.func(html, questions)) for _ in range(3)) < 0.7 * alone


def test_faults_of_odd_ends(spark):
    random = Random(5)
    bits = ["<html>", "<HTML ", "</html>", "</html >", "</HTML>", "<", "<b", ">", "</", "<!", "x", " ", "\n", "<a b='<'", "é", "<1", "\r"]
    pages = spark.createDataFrame([("".join(random.choices(bits, k=at % 8)),) for at in range(2000)], "html string")
    open_root, ended = F.rlike("html", F.lit(r"(?i)<html[\s>]")), F.rlike("html", F.lit(r"(?i)</html\s*>"))
    wanted = F.when((open_root & ~ended) | F.rlike("html", F.lit(r"<[A-Za-z/!][^<>]*\z")), "truncated")
    assert pages.where(~extract._raw_fault(F.col("html")).eqNullSafe(wanted)).count() == 0


def test_a_page_key_is_worked_out_once(spark):
    from docketframe.functions import urls

    made = urls.page_key(F.col("url"))
    pages = spark.createDataFrame([("https://h/a/b.html;x?q",), ("//h/./",), ("c",), (None,)], "url string").select(made.alias("key"))
    assert [r.key for r in pages.collect()] == ["b.html", "index.html", "c.html", None]
    plan = pages._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract") == 1
