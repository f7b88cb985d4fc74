"""What the two built-in page layouts ask of a page, and what they make of the elements: raw text, cleaned elsewhere.

The ``*_ASKED`` lists name settings: selectors, each inside the one before, and the selectors of parts to read in each
element. The functions give SQL expressions over ``found``, the elements in the order of these lists.
"""

from __future__ import annotations

from docketframe.functions.html import GAP

# The selectors used where a configuration names none.
GRID_SELECTORS = {
    "search_result_link": "table#grdCases a.case-link",
    "header_row": "#caseHeader tr",
    "party_row": "table#grdParties tr.party-row",
    "event_row": "table#grdEvents tr.event-row",
}
BLOCK_SELECTORS = {
    "search_result_card": "div.result-card[data-case-number]",
    "case_root": "div.case-detail",
    "case_style": "h1.case-style",
    "case_meta": "dl.case-meta",
    "party_block": "section.parties div.party",
    "party_name": "span.party-name",
    "party_role_attr": "data-role",
    "attorney_item": "ul.attorneys li",
    "event_block": "section.events div.event",
    "event_date": "span.event-date",
    "event_desc": "span.event-desc",
    "event_loc": "span.event-loc",
}
# Header cells of the grid layout, the card's attribute.
GRID_CELLS = {"label_cell": "td.label, th", "value_cell": "td.value", "cell": "td"}
BLOCK_CELLS = {"term": "dt", "definition": "dd"}
REF_ATTRIBUTE = "data-case-number"


GRID_REFS_ASKED = [(["search_result_link"], [])]
BLOCK_REFS_ASKED = [(["search_result_card"], [])]
GRID_CASE_ASKED = [(["header_row"], ["label_cell", "value_cell"]), (["party_row"], ["cell"]), (["event_row"], ["cell"])]
BLOCK_CASE_ASKED = [
    (["case_root"], ["case_style"]),
    (["case_root", "case_meta"], ["term", "definition"]),
    (["party_block"], ["party_name", "attorney_item"]),
    (["event_block"], ["event_date", "event_desc", "event_loc"]),
]


def _plain(text: str) -> str:
    return f"replace({text}, '{GAP}', '')"


def _stacked(text: str) -> str:
    """Text nodes as lines of their own."""
    return f"replace({text}, '{GAP}', '\\n')"


def _first(element: str, part: int, read=_plain) -> str:
    """The first text of a part, null without one."""
    return read(f"get({element}.parts[{part}], 0)")


def _record(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{name}', {value}" for name, value in fields.items()) + ")"


def _pairs(pairs: str) -> str:
    return f"filter({pairs}, pair -> pair.label is not null and pair.value is not null)"


def grid_refs() -> str:
    return f"transform(found[0], link -> {_plain('link.text')})"


def block_refs() -> str:
    return f"transform(found[0], card -> coalesce(card.attributes['{REF_ATTRIBUTE}'], ''))"


def grid_case() -> str:
    def rows(place: int, least: int, record: str) -> str:
        return f"transform(filter(found[{place}], row -> size(row.parts[0]) >= {least}), row -> {record})"

    cell = [f"row.parts[0][{i}]" for i in range(3)]
    party = _record(name=_plain(cell[0]), role=_plain(cell[1]), lines=f"split({_stacked(cell[2])}, '\\n')")
    event = _record(date=_stacked(cell[0]), description=_plain(cell[1]), location="''")
    header = _pairs(f"transform(found[0], row -> {_record(label=_first('row', 0), value=_first('row', 1))})")
    rows_there, short = "size(found[1]) + size(found[2])", "exists(concat(found[1], found[2]), row -> size(row.parts[0]) >= 2)"
    fault = f"case when size({header}) = 0 and {rows_there} = 0 then 'no root' when {rows_there} > 0 and not {short} then 'short rows' end"
    return _record(
        listed_ref="cast(null as string)", style="cast(null as string)", header=header, parties=rows(1, 3, party), events=rows(2, 2, event), fault=fault
    )


def block_case() -> str:
    root = "get(found[0], 0)"
    meta = f"get(filter(found[1], meta -> meta.at > {root}.at and meta.at < {root}.stop), 0)"
    pairs = f"zip_with({meta}.parts[0], {meta}.parts[1], (term, value) -> {_record(label=_plain('term'), value=_plain('value'))})"
    party = _record(
        name=f"coalesce({_first('block', 0)}, '')",
        role="coalesce(block.attributes[party_role_attr], '')",
        lines=f"transform(block.parts[1], line -> {_plain('line')})",
    )
    event = _record(
        date=f"coalesce({_first('block', 0, _stacked)}, '')", description=f"coalesce({_first('block', 1)}, '')", location=f"coalesce({_first('block', 2)}, '')"
    )
    return _record(
        listed_ref=f"coalesce({root}.attributes['{REF_ATTRIBUTE}'], '')",
        style=f"coalesce({_first(root, 0)}, '')",
        header=f"coalesce({_pairs(pairs)}, array())",
        parties=f"transform(found[2], block -> {party})",
        events=f"transform(found[3], block -> {event})",
        fault=f"if({root} is null, 'no root', null)",
    )
