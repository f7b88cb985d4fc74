"""What each query must return, in DuckDB SQL over the same tables.

The raw text is the same (``raw``); everything after it is written
independently, from the source columns wherever they already hold the answer.
"""

from __future__ import annotations

from docketframe.schema import OUTPUT_COLUMNS
from workloads import raw

_SPACE = r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def clean(text: str) -> str:
    return f"trim(regexp_replace({text}, '{_SPACE}', ' ', 'g'))"


def suffix(token: str) -> str:
    key = f"lower(replace({token}, '.', ''))"
    known = {"jr": "Jr.", "sr": "Sr.", "esq": "Esq.", "ii": "II", "iii": "III", "iv": "IV", "v": "V"}
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in known.items())
    return f"(CASE {key} {whens} ELSE '' END)"


_PLACEHOLDERS = (
    "('', 'pro se', 'prose', 'pro-se', 'pro per', 'n/a', 'na', 'none', 'unrepresented', 'not represented', 'no attorney')"
)


def nobody(line: str) -> str:
    return f"(lower(replace({clean(line)}, '.', '')) IN {_PLACEHOLDERS} OR {clean(line)} = ',')"


def _words(text: str) -> str:
    return f"list_filter(string_split({text}, ' '), lambda w: w <> '')"


def split_ctes(source: str, keep: str) -> str:
    """CTEs from ``source(keep..., line)`` to ``split(keep..., first_name, middle_name, last_name, suffix)``."""
    return f"""
    s0 AS (SELECT {keep}, {clean('line')} AS t FROM {source}),
    s1 AS (SELECT *, contains(t, ',') AS comma, {_words('t')} AS w,
                  trim(substr(t, strpos(t, ',') + 1)) AS rest FROM s0),
    s2 AS (SELECT *, trim(string_split(rest, ',')[-1]) AS tail FROM s1),
    s3 AS (SELECT *, CASE WHEN comma THEN CASE WHEN contains(rest, ',') THEN {suffix('tail')} ELSE '' END
                          WHEN len(w) >= 2 THEN {suffix('w[-1]')} ELSE '' END AS suf1 FROM s2),
    s4 AS (SELECT *, CASE WHEN comma THEN {_words("CASE WHEN suf1 <> '' THEN array_to_string(string_split(rest, ',')[:-2], ',') ELSE rest END")}
                          WHEN suf1 <> '' THEN w[:-2] ELSE w END AS body FROM s3),
    s5 AS (SELECT *, CASE WHEN comma THEN trim(split_part(t, ',', 1)) ELSE coalesce(body[-1], '') END AS last_name,
                  CASE WHEN comma THEN body ELSE body[:-2] END AS given FROM s4),
    s6 AS (SELECT *, CASE WHEN suf1 = '' AND len(given) > 0 THEN {suffix('given[-1]')} ELSE '' END AS suf2 FROM s5),
    s7 AS (SELECT *, CASE WHEN suf2 <> '' THEN given[:-2] ELSE given END AS names FROM s6),
    split AS (SELECT {keep}, coalesce(names[1], '') AS first_name,
                     coalesce(array_to_string(names[2:], ' '), '') AS middle_name, last_name,
                     CASE WHEN suf1 <> '' THEN suf1 ELSE suf2 END AS suffix FROM s7)"""


_ORDERS = "orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"
_EVENT = (
    f"concat({raw.date_expected('l_shipdate', 'l_linenumber + l_partkey')}, ' — Flag ', l_returnflag, ' — ', l_linestatus,"
    " CASE WHEN l_suppkey % 3 > 0 THEN concat(' [Courtroom ', l_suppkey, ']') ELSE '' END)"
)


def _attorneys(source: str = "orders") -> str:
    """CTEs up to ``pairs(o_orderkey, pair_pos, party_role, names)`` of the listed attorneys."""
    slots = " UNION ALL ".join(
        f"SELECT o_orderkey, {slot} AS slot, 'Plaintiff' AS party_role, {raw.plaintiff_line(slot)} AS line FROM orders"
        for slot in range(3)
    )
    slots += f" UNION ALL SELECT o_orderkey, 3, 'Defendant', {raw.DEFENDANT_LINE} FROM orders"
    return f"""
    slots AS ({slots}),
    listed AS (SELECT * FROM slots WHERE line IS NOT NULL AND NOT {nobody('line')}),
    {split_ctes('listed', 'o_orderkey, slot, party_role')},
    pairs AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY slot) - 1 AS pair_pos FROM split)"""


def _events(order: str) -> str:
    """CTE ``cells(o_orderkey, events_primary, events_cont)``."""
    return f"""
    lines AS (SELECT l_orderkey AS o_orderkey, {_EVENT} AS line,
                     row_number() OVER (PARTITION BY l_orderkey ORDER BY {order}, {_EVENT}) AS n
              FROM lineitem WHERE {raw.EVENT_SHOWN}),
    cells AS (SELECT o_orderkey, max(CASE WHEN n = 1 THEN line END) AS events_primary,
                     coalesce(string_agg(line, '; ' ORDER BY n) FILTER (WHERE n > 1), '') AS events_cont
              FROM lines GROUP BY o_orderkey)"""


_FILED = raw.date_expected("o_orderdate", "o_orderkey")
_COURT = f"coalesce({raw.COURT_RAW}, '{raw.DEFAULT_COURT}')"


def _rows(order: str) -> str:
    """CTE ``found``: the 14 columns and what orders them."""
    return f"""
    {_attorneys()}, {_events(order)},
    found AS (
      SELECT {raw.COUNTY} AS county, {raw.CASE_REF} AS case_number, {raw.CASE_NAME} AS case_name, {_FILED} AS filing_date,
             c_mktsegment AS case_type, o_orderstatus AS status, {_COURT} AS court,
             coalesce(first_name, '') AS first_name, coalesce(middle_name, '') AS middle_name,
             coalesce(last_name, '') AS last_name, coalesce(suffix, '') AS suffix, coalesce(party_role, '') AS party_role,
             coalesce(events_primary, '') AS events_primary, coalesce(events_cont, '') AS events_cont,
             n_nationkey, o_orderkey, coalesce(pair_pos, 0) AS pair_pos
      FROM {_ORDERS} LEFT JOIN pairs USING (o_orderkey) LEFT JOIN cells USING (o_orderkey))"""


_COLUMNS = (
    "county, case_number, case_name, filing_date, case_type, status, court, first_name, middle_name, last_name, suffix,"
    " party_role, events_primary, events_cont"
)
_BY_LINE, _BY_ITEM = "l_linenumber", raw.EVENT_ORDER
_ROWS_BY_LINE = f"WITH {_rows(_BY_LINE)} SELECT DISTINCT {_COLUMNS} FROM found"
_ROWS_BY_ITEM = f"WITH {_rows(_BY_ITEM)} SELECT DISTINCT {_COLUMNS} FROM found"
_PLACE = (
    f"CAST(n_nationkey AS HUGEINT) * CAST('1' || repeat('0', 29) AS HUGEINT)"
    f" + (CAST(o_orderkey // {raw.BLOCK} AS HUGEINT) * 4294967296 + o_orderkey % {raw.BLOCK}) * 10000000000 + pair_pos"
)

_SITE = r"coalesce(nullif(regexp_extract(url, '^https?://[^/?#]*\.(com|net)(:[0-9]+)?([/?#]|$)', 1), ''), 'org')"
_NAV = f"""
    found AS (SELECT {_SITE} AS county_key, page_id, CAST(page_id AS VARCHAR) AS page_key,
                     regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a>', 1) AS links FROM pages),
    placed AS (SELECT county_key, page_id, page_key, unnest(links) AS link, generate_subscripts(links, 1) - 1 AS ref_pos FROM found),
    refs AS (SELECT county_key, page_id, page_key, CAST(ref_pos AS INTEGER) AS ref_pos, {clean('link')} AS case_ref
             FROM placed WHERE {clean('link')} <> '')"""
_PAGE_REFS = f"WITH {_NAV} SELECT county_key, page_key, ref_pos, case_ref FROM refs"
_PAGE_KEY = (
    "CASE WHEN regexp_replace(url, '^https?://[^/]*|[?#].*$', '', 'g') IN ('', '/') THEN 'index.html' ELSE"
    " regexp_replace(regexp_extract(regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', ''), '([^/]*)$', 1),"
    " '([.]html)?$', '.html') END"
)


def _dates(text: str) -> str:
    """Format trials in order, each behind the shape it may take."""
    numeric, two, year = "[0-9]{1,2}", "[0-9]{2}", "[0-9]{4}"
    trials = [
        (f"{numeric}/{numeric}/{year}", "%m/%d/%Y"),
        (f"{numeric}-{numeric}-{year}", "%m-%d-%Y"),
        (f"{numeric}/{numeric}/{two}", "%m/%d/%y"),
        (f"{year}-{numeric}-{numeric}", "%Y-%m-%d"),
        (f"[A-Za-z]+ {numeric}, {year}", "%B %d, %Y"),
        (f"[A-Za-z]+ {numeric}, {year}", "%b %d, %Y"),
        (f"{numeric} [A-Za-z]+ {year}", "%d %b %Y"),
    ]
    tried = ", ".join(
        f"CASE WHEN regexp_full_match({text}, '{shape}') THEN strftime(try_strptime({text}, '{form}'), '%Y-%m-%d') END"
        for shape, form in trials
    )
    return f"coalesce({tried}, {text})"


def _numbers(pattern: str) -> str:
    """``n(county_key, case_number, spec_ord, place)`` of one pattern's specs, duplicates kept."""
    county = "concat('n', c_nationkey)"
    year = "lpad(CAST(c_custkey % 3 AS VARCHAR), 2, '0')"

    def number(width: str, tail: str) -> str:
        digits = f"CASE WHEN length(CAST(seq AS VARCHAR)) >= {width} THEN CAST(seq AS VARCHAR) ELSE lpad(CAST(seq AS VARCHAR), CAST({width} AS INTEGER), '0') END"
        return f"concat({year}, '/', {digits}, '.', {tail})"

    first, last = "c_custkey * 5 + 1", "c_custkey * 5 + 1 + c_custkey % 7"
    if pattern == "plain":
        return f"""SELECT {county} AS county_key, {number('1 + c_custkey % 6', "''")} AS case_number, c_custkey AS spec_ord,
                   seq - ({first}) AS place FROM customer, unnest(generate_series({first}, {last})) AS u(seq)"""
    if pattern == "letter_suffix":
        letters = "CASE WHEN c_custkey % 2 = 1 THEN ['X', 'B', 'Z'] ELSE ['A', 'B', 'C', 'D', 'E', 'F', 'G', 'H'] END"
        return f"""SELECT {county} AS county_key, {number('6', 'letters[i]')} AS case_number, c_custkey AS spec_ord,
                   (seq - ({first})) * len(letters) + i - 1 AS place
                   FROM (SELECT *, {letters} AS letters FROM customer), unnest(generate_series({first}, {last})) AS u(seq),
                        unnest(generate_series(1, len(letters))) AS v(i)"""
    return f"""SELECT {county} AS county_key, {number('6', "'G'")} AS case_number, c_custkey AS spec_ord,
               seq - c_custkey * 2 AS place
               FROM customer, unnest(generate_series(c_custkey * 2, c_custkey * 2 + c_custkey % 3)) AS u(seq)
               UNION ALL
               SELECT {county}, {number('6', "'E'")}, c_custkey, c_custkey % 3 + 1 + seq - c_custkey
               FROM customer, unnest(generate_series(c_custkey, c_custkey + 2)) AS u(seq)"""


def _ordinal(spec: str) -> str:
    return f"(CAST({spec} AS HUGEINT) * CAST('1' || repeat('0', 19) AS HUGEINT) + place)"


def _enumerated(pattern: str) -> str:
    return f"SELECT county_key, case_number, CAST({_ordinal('spec_ord')} AS VARCHAR) AS ordinal FROM ({_numbers(pattern)})"


_ALL_NUMBERS = " UNION ALL ".join(
    f"SELECT county_key, case_number, {_ordinal(f'(spec_ord * 3 + {i})')} AS ordinal FROM ({_numbers(p)})"
    for i, p in enumerate(["plain", "letter_suffix", "per_suffix"])
)
_UNIQUE_NUMBERS = f"SELECT county_key, case_number, CAST(min(ordinal) AS VARCHAR) AS ordinal FROM ({_ALL_NUMBERS}) GROUP BY ALL"

_PROGRESS = f"""SELECT DISTINCT lang AS county_key, CAST(doc_id AS VARCHAR) AS n FROM documents
                WHERE {raw.pick('doc_id', ['good', 'good', 'torn', 'good', 'other', 'blank', 'good'])} = 'good'"""

_PATTERN = raw.pick("c_custkey", ["plain", "letter_suffix", "per_suffix", "zigzag", "per_suffix"])
_START = "CASE WHEN c_custkey % 7 = 0 THEN 1 ELSE c_custkey % 11 END"
_END = "CASE WHEN c_custkey % 6 = 0 THEN 1 ELSE c_custkey % 13 END"

_LISTED = f"""
    listing AS (SELECT {raw.COUNTY_KEY} AS county_key, {raw.CASE_REF} AS case_ref, o_orderkey, o_orderstatus, o_orderpriority FROM {_ORDERS})"""

_STATES = f"""
    WITH {_LISTED}
    SELECT county_key, case_ref, CASE WHEN o_orderstatus = 'P' THEN 'missing'
                                          WHEN o_orderpriority = '1-URGENT' THEN 'failed' ELSE 'ok' END AS state FROM listing"""

CHECKS = {
    "clean_text_documents": f"SELECT doc_id, {clean('text')} AS clean FROM documents",
    "placeholder_filter": f"""
        SELECT c_custkey, line FROM (
          SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN {raw.name_line('c_custkey')}
                                 ELSE {raw.pick('c_custkey', raw.PLACEHOLDER_LINES)} END AS line FROM customer)
        WHERE NOT {nobody('line')}""",
    "normalize_dates": f"""
        SELECT o_orderkey, {_dates('t')} AS filed FROM (SELECT o_orderkey, {clean(raw.FILED_RAW)} AS t FROM orders)""",
    "norm_suffix": f"""
        SELECT p_partkey, token, {suffix('token')} AS suffix
        FROM (SELECT p_partkey, {raw.pick('p_partkey', raw.TOKENS)} AS token FROM part)""",
    "split_names": f"""
        WITH named AS (SELECT o_orderkey, {raw.odd_name('o_orderkey + o_custkey')} AS line FROM orders),
        {split_ctes('named', 'o_orderkey')} SELECT * FROM split""",
    "split_stacked": f"""
        WITH cells AS (
          SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
                 concat(' ', {raw.EVENT_DATE_RAW},
                        {raw.pick('l_suppkey', [chr(10), ' ' + chr(13) + chr(10) + ' ', chr(10) * 2 + chr(9) + chr(10), raw.NBSP + chr(10) + raw.NBSP, ''])},
                        {raw.EVENT_PLACE}, chr(10), 'Floor  ', l_returnflag, chr(10), ' ') AS cell FROM lineitem),
        parts AS (
          SELECT *, list_filter(list_transform(regexp_split_to_array(cell, '[\\r\\n]+'), lambda p: {clean('p')}),
                                lambda p: p <> '') AS p FROM cells)
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, coalesce(p[1], '') AS date,
               coalesce(array_to_string(p[2:], ' '), '') AS location FROM parts""",
    "format_events": f"""
        SELECT l_orderkey AS o_orderkey, {raw.EVENT_ORDER} AS place,
               CASE WHEN {raw.EVENT_SHOWN} THEN {_EVENT} ELSE '' END AS event FROM lineitem""",
    "events_primary_cont": f"WITH {_events(_BY_LINE)} SELECT * FROM cells",
    "explode_attorneys": f"""
        WITH {_attorneys()}
        SELECT o_orderkey, coalesce(pair_pos, 0) AS pair_pos, coalesce(party_role, '') AS party_role,
               coalesce(first_name, '') AS first_name, coalesce(middle_name, '') AS middle_name,
               coalesce(last_name, '') AS last_name, coalesce(suffix, '') AS suffix
        FROM (SELECT o_orderkey FROM {_ORDERS}) LEFT JOIN pairs USING (o_orderkey)""",
    "attorney_rows": _ROWS_BY_LINE,
    "nested_case_rows": _ROWS_BY_ITEM,
    "dedup_rows": f"""
        WITH {_rows(_BY_LINE)}
        SELECT {_COLUMNS}, CAST(min({_PLACE}) AS VARCHAR) AS row_ord FROM found GROUP BY {_COLUMNS}""",
    "stable_sort_rank": f"""
        WITH {_rows(_BY_LINE)},
        kept AS (SELECT {_COLUMNS}, min({_PLACE}) AS place FROM found GROUP BY {_COLUMNS})
        SELECT row_number() OVER (ORDER BY county, case_number, last_name, first_name, place) - 1 AS position,
               case_number, last_name, first_name, middle_name, suffix, party_role FROM kept""",
    "page_refs": _PAGE_REFS,
    "page_refs_by_pattern": _PAGE_REFS,
    "user_extraction_sql": _PAGE_REFS,
    "user_extraction": f"WITH {_NAV} SELECT county_key, page_key, count(*) AS n_refs FROM refs GROUP BY ALL",
    "page_first_seen_refs": f"""
        WITH {_NAV}, ranked AS (
          SELECT *, row_number() OVER (PARTITION BY county_key, case_ref ORDER BY page_id, ref_pos) AS n FROM refs)
        SELECT county_key, case_ref, CAST(page_id AS INTEGER) AS page_ord, ref_pos FROM ranked WHERE n = 1""",
    "page_headings": f"""
        SELECT {_SITE} AS county_key, CAST(page_id AS VARCHAR) AS page_key,
               {clean("replace(regexp_extract(html, '<h1>(.*?)</h1>', 1, 's'), '&amp;', '&')")} AS case_name FROM pages""",
    "page_key_from_url": f"SELECT page_id, {_PAGE_KEY} AS page_key FROM pages",
    "build_urls": f"""
        SELECT o_orderkey,
               concat('https://records.invalid/n', n_nationkey, '/Search/results_', o_orderkey // {raw.BLOCK}) AS search_url,
               concat('https://records.invalid/n', n_nationkey, '/Case/', {raw.CASE_REF}) AS case_url FROM {_ORDERS}""",
    "refs_join_pages": f"""
        SELECT concat('Site ', site) AS county, CAST(p_partkey AS VARCHAR) AS case_ref, page_id
        FROM (SELECT p_partkey, {raw.pick('p_partkey', ['com', 'net', 'org'])} AS site FROM part)
        JOIN (SELECT page_id, {_SITE} AS page_site, {_PAGE_KEY} AS page_key FROM pages)
          ON site = page_site AND concat(p_partkey, '.html') = page_key""",
    "skip_done": """
        SELECT o_orderpriority AS county_key, CAST(o_orderkey AS VARCHAR) AS case_ref FROM orders
        WHERE (o_orderpriority, o_orderkey) NOT IN (SELECT (o_orderpriority, o_orderkey) FROM orders WHERE o_orderstatus = 'F')""",
    "skip_done_documents": """
        SELECT CAST(doc_id AS VARCHAR) AS case_ref FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "checkpoint_scan": _PROGRESS,
    "completed_count": f"SELECT county_key, count(*) AS completed FROM ({_PROGRESS}) GROUP BY county_key",
    "case_numbers_plain": _enumerated("plain"),
    "case_numbers_letter_suffix": _enumerated("letter_suffix"),
    "case_numbers_per_suffix": _enumerated("per_suffix"),
    "case_numbers_listing": _UNIQUE_NUMBERS,
    "case_numbers_dedup_count": f"SELECT county_key, count(*) AS candidates FROM ({_UNIQUE_NUMBERS}) GROUP BY county_key",
    "invalid_specs": f"""
        WITH specs AS (
          SELECT c_custkey AS spec_ord, concat('n', c_nationkey) AS county_key, {_PATTERN} AS pattern,
                 CAST({_START} AS BIGINT) AS a, CAST({_END} AS BIGINT) AS b, c_custkey % 10 < 5 AS ranged,
                 c_custkey % 4 AS lo, c_custkey % 3 AS hi FROM customer)
        SELECT spec_ord, county_key, a AS start, b AS "end",
               CASE WHEN pattern = 'zigzag' THEN 'no such pattern: ''zigzag'' (there are plain, letter_suffix, per_suffix)'
                    WHEN pattern <> 'per_suffix' AND a > b THEN concat('range runs backwards: ', a, ' to ', b)
                    WHEN pattern = 'per_suffix' AND NOT ranged THEN 'no range for any suffix'
                    WHEN pattern = 'per_suffix' AND lo > hi
                      THEN concat('range of suffix A runs backwards: ', lo, ' to ', hi)
                    ELSE '' END AS problem FROM specs""",
    "county_summary": f"""
        WITH {_rows(_BY_ITEM)},
        a AS (SELECT county, count(DISTINCT o_orderkey) AS cases, count(*) AS n FROM found GROUP BY county),
        k AS (SELECT county, count(*) AS kept FROM (SELECT DISTINCT {_COLUMNS} FROM found) GROUP BY county),
        t AS (SELECT {raw.COUNTY} AS county, count(*) AS attorneys FROM {_ORDERS} JOIN pairs USING (o_orderkey) GROUP BY 1),
        per AS (SELECT county, cases, cases * 2 AS parties, attorneys, n AS rows_before_dedup, kept AS rows
                FROM a JOIN k USING (county) JOIN t USING (county))
        SELECT coalesce(county, 'all') AS county, CAST(sum(cases) AS BIGINT) AS cases, CAST(sum(parties) AS BIGINT) AS parties,
               CAST(sum(attorneys) AS BIGINT) AS attorneys, CAST(sum(rows_before_dedup) AS BIGINT) AS rows_before_dedup,
               CAST(sum(rows) AS BIGINT) AS rows FROM per GROUP BY ROLLUP (county)""",
    "header_from_pages": f"""
        SELECT {raw.COUNTY_KEY} AS county_key, concat({raw.CASE_REF}, '.html') AS page_key, {raw.CASE_REF} AS case_number,
               {raw.CASE_NAME} AS case_name, {_FILED} AS filing_date, c_mktsegment AS case_type, o_orderstatus AS status,
               coalesce({raw.COURT_RAW}, '(none)') AS court FROM {_ORDERS}""",
    "parties_from_pages": f"""
        WITH {_attorneys()},
        kept AS (SELECT o_orderkey, party_role, {clean('line')} AS line,
                        row_number() OVER (PARTITION BY o_orderkey, party_role ORDER BY slot) - 1 AS line_pos FROM listed),
        both_parties AS (
          SELECT o_orderkey, 0 AS party_pos, c_name AS name, 'Plaintiff' AS role FROM {_ORDERS}
          UNION ALL SELECT o_orderkey, 1, 'State', 'Defendant' FROM {_ORDERS})
        SELECT concat({raw.CASE_REF}, '.html') AS page_key, CAST(party_pos AS BIGINT) AS party_pos, name, role,
               coalesce(line_pos, -1) AS line_pos, coalesce(line, '') AS line
        FROM both_parties LEFT JOIN (SELECT o_orderkey, party_role AS role, line, line_pos FROM kept) USING (o_orderkey, role)""",
    "events_from_pages": f"""
        SELECT concat({raw.CASE_REF}, '.html') AS page_key,
               row_number() OVER (PARTITION BY l_orderkey ORDER BY {raw.EVENT_ORDER}) - 1 AS event_pos,
               CASE WHEN {raw.EVENT_SHOWN} THEN {raw.date_expected('l_shipdate', 'l_linenumber + l_partkey')} ELSE '' END AS date,
               {raw.EVENT_DESC} AS description, {raw.EVENT_PLACE} AS location
        FROM lineitem JOIN ({'SELECT o_orderkey FROM ' + _ORDERS}) ON l_orderkey = o_orderkey""",
    "listed_refs": f"""
        SELECT {raw.COUNTY_KEY} AS county_key, {raw.CASE_REF} AS case_ref, o_orderkey // {raw.BLOCK} AS page_ord FROM {_ORDERS}""",
    "attorney_rows_from_pages": _ROWS_BY_ITEM,
    "quarantine_pages": _STATES,
    "results_page_states": f"""
        WITH listed AS (SELECT {raw.COUNTY_KEY} AS county_key, o_orderkey // {raw.BLOCK} AS block, o_orderkey FROM {_ORDERS}),
        blocks AS (SELECT county_key, block AS page_ord FROM listed UNION SELECT county_key, block + 1 FROM listed WHERE o_orderkey % 10 = 0)
        SELECT county_key, CAST(page_ord AS BIGINT) AS page_ord,
               CASE WHEN page_ord % 5 = 3 THEN 'missing' WHEN page_ord % 5 = 1 THEN 'failed' ELSE 'ok' END AS state,
               CASE WHEN page_ord % 5 = 1 THEN 'page has no content' ELSE '' END AS error FROM blocks""",
    "resume_rows": f"""
        SELECT {raw.COUNTY} AS county, count(*) AS cases, CAST(0 AS BIGINT) AS added_by_second_run FROM {_ORDERS}
        WHERE o_orderstatus <> 'P' AND o_orderpriority <> '1-URGENT' GROUP BY 1""",
    "incremental_pages": f"""
        WITH {_rows(_BY_ITEM)},
        on_page AS (SELECT n_nationkey, o_orderkey, o_orderkey // {raw.BLOCK} AS block FROM {_ORDERS}
                    UNION ALL SELECT n_nationkey, o_orderkey, o_orderkey // {raw.BLOCK} + 1 FROM {_ORDERS} WHERE o_orderkey % 10 = 0),
        numbered AS (SELECT o_orderkey, block, row_number() OVER (PARTITION BY n_nationkey, block ORDER BY o_orderkey) - 1 AS ref_pos FROM on_page),
        placed AS (SELECT * FROM numbered WHERE block = o_orderkey // {raw.BLOCK})
        SELECT {_COLUMNS}, CAST(min(
            CAST(n_nationkey AS HUGEINT) * CAST('1' || repeat('0', 29) AS HUGEINT)
            + (CAST(block AS HUGEINT) * 4294967296 + ref_pos) * 10000000000 + pair_pos) AS VARCHAR) AS row_ord
        FROM found JOIN placed USING (o_orderkey) GROUP BY {_COLUMNS}""",
    "incremental_states": _STATES,
    **dict.fromkeys(
        ("newest_pages", "incremental_versions"), f"SELECT {raw.COUNTY_KEY} AS county_key, {raw.CASE_REF} AS case_ref, o_orderstatus AS status FROM {_ORDERS}"
    ),
    "csv_export": _ROWS_BY_LINE,
    "csv_of_nothing": f"SELECT '{','.join(OUTPUT_COLUMNS.values())}' AS header, count(*) AS n_rows FROM orders WHERE o_orderkey < 0",
    "csv_titles": "SELECT " + ", ".join(f'{name} AS "{title}"' for name, title in OUTPUT_COLUMNS.items()) + f" FROM ({_ROWS_BY_LINE})",
    "candidate_listing": f"""
        SELECT concat(n_name, ' County') AS county, count(*) OVER (PARTITION BY county_key) AS candidates, case_number,
               row_number() OVER (ORDER BY n_nationkey, CAST(ordinal AS HUGEINT)) - 1 AS position
        FROM ({_UNIQUE_NUMBERS}) JOIN nation ON county_key = concat('n', n_nationkey)""",
    "number_gaps": f"""
        WITH there AS (SELECT DISTINCT {raw.COUNTY_KEY} AS county_key, o_orderkey AS seq FROM {_ORDERS}),
        ranges AS (SELECT concat('n', n_nationkey) AS county_key, unnest([
                       {{'lo': CAST(n_nationkey * 10 AS BIGINT), 'hi': CAST(most - n_nationkey * 7 AS BIGINT)}},
                       {{'lo': CAST(5 AS BIGINT), 'hi': CAST(n_nationkey AS BIGINT)}}, {{'lo': CAST(1 AS BIGINT), 'hi': CAST(40 AS BIGINT)}}]) AS part
                   FROM (SELECT n_nationkey, max(o_orderkey) AS most FROM {_ORDERS} GROUP BY n_nationkey)),
        wanted AS (SELECT DISTINCT county_key, unnest(generate_series(part.lo, part.hi)) AS seq FROM ranges WHERE part.lo <= part.hi),
        sides AS (SELECT coalesce(w.county_key, t.county_key) AS county_key, coalesce(w.seq, t.seq) AS seq,
                         CASE WHEN t.seq IS NULL THEN 'missing' ELSE 'unexpected' END AS side
                  FROM wanted w FULL JOIN there t ON w.county_key = t.county_key AND w.seq = t.seq WHERE w.seq IS NULL OR t.seq IS NULL),
        runs AS (SELECT *, seq - row_number() OVER (PARTITION BY county_key, side ORDER BY seq) AS run FROM sides)
        SELECT county_key, side, min(seq) AS "first", max(seq) AS "last", max(seq) - min(seq) + 1 AS n FROM runs GROUP BY county_key, side, run""",
    "stored_party_names": f"""
        WITH {_rows(_BY_ITEM)}
        SELECT {raw.CASE_REF} AS case_ref, party_role, CASE party_role WHEN 'Plaintiff' THEN c_name WHEN 'Defendant' THEN 'State' ELSE '' END AS party_name, last_name
        FROM found JOIN (SELECT o_orderkey, c_name FROM {_ORDERS}) USING (o_orderkey)""",
    "rows_and_attributes_left_out": """
        SELECT 'n0' AS county_key, CAST(p_partkey AS VARCHAR) AS page_key, '' AS case_number,
               CAST(p_partkey % 4 >= 2 AS BIGINT) AS parties, CAST(p_partkey % 3 = 2 AS BIGINT) AS events,
               CASE WHEN p_partkey % 4 >= 2 THEN CAST(p_partkey AS VARCHAR) ELSE '' END AS name,
               CASE WHEN p_partkey % 4 >= 2 THEN CAST(p_partkey AS VARCHAR) ELSE '' END AS role FROM part
        UNION ALL
        SELECT 'n1', CAST(p_partkey AS VARCHAR), CASE WHEN p_partkey % 5 > 0 THEN CAST(p_partkey AS VARCHAR) ELSE '' END, 1, 0,
               CAST(p_partkey AS VARCHAR), CASE WHEN p_partkey % 2 = 0 THEN 'Plaintiff' ELSE '' END FROM part""",
    "page_faults": f"""
        WITH listed AS (SELECT {raw.COUNTY_KEY} AS county_key, n_nationkey, o_orderkey // {raw.BLOCK} AS block, o_orderkey, {raw.CASE_REF} AS case_ref FROM {_ORDERS}),
        blocks AS (SELECT county_key, block FROM listed UNION SELECT county_key, block + 1 FROM listed WHERE o_orderkey % 10 = 0)
        SELECT 'case' AS kind, county_key, concat(case_ref, '.html') AS page_key,
               CASE o_orderkey % 7 WHEN 0 THEN 'empty' WHEN 1 THEN 'truncated' WHEN 2 THEN 'undecodable' WHEN 3 THEN 'no root'
                    WHEN 4 THEN CASE WHEN n_nationkey % 2 = 0 THEN 'short rows' ELSE 'no root' END ELSE '' END AS fault FROM listed
        UNION ALL
        SELECT 'search', county_key, concat('results_', block, '.html'),
               CASE block % 7 WHEN 0 THEN 'empty' WHEN 1 THEN 'truncated' WHEN 2 THEN 'undecodable' WHEN 3 THEN 'no references'
                    WHEN 4 THEN 'no references' ELSE '' END FROM blocks""",
    "unclosed_and_nested": """
        SELECT 'n0' AS county_key, CAST(p_partkey AS VARCHAR) AS page_key, '' AS case_name,
               CAST(CASE WHEN p_partkey % 4 >= 1 THEN 2 ELSE 1 END AS BIGINT) AS parties,
               CASE WHEN p_partkey % 4 >= 1 THEN concat(p_partkey, 'in') ELSE 'a' END AS name,
               CASE WHEN p_partkey % 4 >= 1 THEN concat(p_partkey, '|in') ELSE 'c' END AS lines FROM part
        UNION ALL
        SELECT 'n1', CAST(p_partkey AS VARCHAR), 's & t', p_partkey % 4 + 1, CAST(p_partkey AS VARCHAR), 'A B|C D' FROM part""",
}
