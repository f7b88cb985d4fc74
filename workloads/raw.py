"""Raw court-like text derived from the benchmark tables.

These SQL snippets are valid in Spark and in DuckDB alike, so that a query and
its check start from the same raw text and differ only in how they process it.
"""

from __future__ import annotations

NBSP, TAB, EM = "\u00a0", "\t", "\u2014"

FIRST = ["Ewan", "Tilda", "Mei-Lin", "Chidi", "Ulf", "Ines", "Bo", "Haru"]
MIDDLE = ["R.", "", "Odile", "Von Der", "B."]
LAST = ["Archer", "O''Leary", "De La Vega", "Sato", "Fitzwilliam", "Adeyemi", "Tran", "Van Dyke", "Roh", "Jr", "Mehta"]
SUFFIX = ["", "Jr.", "III", "", "esq", "J.R.", "SR", "", "V", ".ii."]
TOKENS = SUFFIX[1:] + ["junior", "iv.", "IIII", "Esq..", "x", "Sr Jr", "."]
PLACEHOLDER_LINES = [
    "Pro Se", " PRO  SE. ", "n/a", "N.A.", "None", "Unrepresented", "Not" + NBSP + "Represented", "No Attorney", "pro-se",
    "", NBSP, "Pro Per", "prose", "no attorneys", "Nona", "Pro Se Litigant",
]
MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November",
          "December"]


def pick(key: str, values: list[str]) -> str:
    return f"split_part('{'|'.join(values)}', '|', CAST(({key}) % {len(values)} AS INT) + 1)"


def name_line(key: str) -> str:
    """A person's name in one of four written orders."""
    first, middle = pick(key, FIRST), pick(f"({key}) * 3 + 1", MIDDLE)
    last, suffix = pick(f"({key}) * 5 + 2", LAST), pick(f"({key}) * 7 + 3", SUFFIX)
    return (
        f"(CASE CAST(({key}) % 4 AS INT)"
        f" WHEN 0 THEN concat({last}, ', ', {first}, ' ', {middle}, ' ', {suffix})"
        f" WHEN 1 THEN concat({first}, '  ', {middle}, ' ', {last}, ' ', {suffix})"
        f" WHEN 2 THEN concat({last}, ',{TAB}', {first}, ' ', {middle}, ', ', {suffix})"
        f" ELSE concat('{NBSP} ', {suffix}, ' ', {first}, '{NBSP}', {last}, ' ') END)"
    )


def odd_name(key: str) -> str:
    """Name forms at the edges of the splitting rules, and ordinary ones."""
    odd = ["Archer, Jr.", "Archer Jr., Ewan", "Ewan Jr Archer", "V Archer", "Jr.", "Ewan Q Jr Esq", "Archer, Ewan,", ",",
           ", Jr.", ", ,", "Roh, A, B, J.R.", "Jr Sr", "Archer, , Jr"]
    return f"(CASE WHEN ({key}) % 3 = 0 THEN {pick(f'({key}) * 2', odd)} ELSE {name_line(key)} END)"


def date_line(day: str, key: str) -> str:
    """A date in one of seven written forms, or text that is no date."""
    y, m, d = (f"CAST({part}({day}) AS STRING)" for part in ("year", "month", "day"))
    month = pick(f"month({day}) - 1", MONTHS)
    short = f"substr({month}, 1, 3)"
    return (
        f"(CASE CAST(({key}) % 9 AS INT)"
        f" WHEN 0 THEN concat(lpad({m}, 2, '0'), '/', lpad({d}, 2, '0'), '/', {y})"
        f" WHEN 1 THEN concat({m}, '-', {d}, '-', {y})"
        f" WHEN 2 THEN concat({m}, '/', {d}, '/', substr({y}, 3, 2))"
        f" WHEN 3 THEN concat({y}, '-', lpad({m}, 2, '0'), '-', lpad({d}, 2, '0'))"
        f" WHEN 4 THEN concat(' ', {month}, '{NBSP}', {d}, ',  ', {y})"
        f" WHEN 5 THEN concat(lower({short}), ' ', {d}, ', ', {y})"
        f" WHEN 6 THEN concat({d}, ' ', upper({short}), ' ', {y})"
        f" WHEN 7 THEN concat('TBD ', {y})"
        f" ELSE concat('13/45/', {y}) END)"
    )


def date_expected(day: str, key: str) -> str:
    """What :func:`date_line` normalizes to, in DuckDB SQL, straight from the date."""
    return (
        f"(CASE CAST(({key}) % 9 AS INT) WHEN 7 THEN concat('TBD ', year({day}))"
        f" WHEN 8 THEN concat('13/45/', year({day})) ELSE strftime({day}, '%Y-%m-%d') END)"
    )


# One case per order.
COUNTY_KEY = "concat('n', CAST(n_nationkey AS STRING))"
COUNTY = "concat(n_name, ' County')"
CASE_REF = "concat('C-', lpad(CAST(o_orderkey AS STRING), 12, '0'))"
CASE_NAME = "concat(c_name, ' & Co. vs. ', o_orderpriority)"
DEFAULT_COURT = "General Court"
COURT_RAW = "(CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE concat('Court No. ', CAST(o_custkey % 17 AS STRING)) END)"
FILED_RAW = date_line("o_orderdate", "o_orderkey")
BLOCK = 1250  # order keys per results page of a county


def plaintiff_line(slot: int) -> str:
    """Null where the plaintiff has fewer attorneys (0 to 3)."""
    return f"(CASE WHEN o_orderkey % 4 > {slot} THEN {name_line(f'o_orderkey * 3 + o_custkey + {slot * 7}')} END)"


DEFENDANT_LINE = (
    f"(CASE CAST(o_orderkey % 3 AS INT) WHEN 0 THEN 'Pro Se' WHEN 1 THEN {name_line('o_orderkey + o_custkey + 11')}"
    f" ELSE '{NBSP}' END)"
)

# One event per line item; items of quantity 1 are blank events.
EVENT_SHOWN = "l_quantity > 1"
EVENT_DATE_RAW = f"(CASE WHEN {EVENT_SHOWN} THEN {date_line('l_shipdate', 'l_linenumber + l_partkey')} ELSE '' END)"
EVENT_DESC = f"(CASE WHEN {EVENT_SHOWN} THEN concat('Flag ', l_returnflag, ' {EM} ', l_linestatus) ELSE '' END)"
EVENT_PLACE = (
    f"(CASE WHEN {EVENT_SHOWN} AND l_suppkey % 3 > 0 THEN concat('Courtroom ', CAST(l_suppkey AS STRING)) ELSE '' END)"
)
# A total order of an order's items, for up to 10**9 parts and 10**8 suppliers.
EVENT_ORDER = "l_linenumber * 100000000000000000 + l_partkey * 100000000 + l_suppkey"
