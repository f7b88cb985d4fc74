"""Synthetic pages of two invented counties, and their expected rows, worked out by hand."""

GRID = {
    "key": "juniper",
    "county": "Juniper County",
    "adapter": "aspnet_public_access",
    "base_url": "https://records.invalid/juniper",
    "court": "Juniper Circuit",
    "selectors": {
        "search_result_link": "table#grdCases a.case-link",
        "header_row": "#caseHeader tr",
        "party_row": "table#grdParties tr.party-row",
        "event_row": "table#grdEvents tr.event-row",
    },
    "search_pages": ["results_1"],
    "sequences": [
        {"pattern": "plain", "template": "JN{seq}-{year}", "extra": {"year": 19}, "start": 41, "end": 52, "width": 5}
    ],
}
BLOCK = {
    "key": "sorrel",
    "county": "Sorrel County",
    "adapter": "js_portal",
    "base_url": "https://records.invalid/sorrel",
    "court": "Sorrel Bench",
    "selectors": {},
    "search_pages": ["results_1", "results_2", "results_7"],
    "sequences": [
        {"pattern": "letter_suffix", "template": "SR-{seq}-{suffix}", "start": 12, "end": 14, "width": 3, "suffixes": ["X", "Y"]},
        {
            "pattern": "per_suffix",
            "template": "SP-{seq}-{suffix}",
            "width": 4,
            "suffixes": ["K", "L", "M"],
            "per_suffix_ranges": {"M": {"start": 8, "end": 8}, "K": {"start": 30, "end": 34}},
        },
    ],
}
COUNTIES = [GRID, BLOCK]

GRID_RESULTS = """<!DOCTYPE html><html><body><form><input type=hidden value=x>
<table id="grdCases"><tr><th>Number<th>Style</tr>
{rows}
</table><a class="case-link" href="#">outside the grid</a></form></body></html>""".format(
    rows="\n".join(
        f'<tr><td><a class="case-link wide" href="./Case/{ref}"> {ref}\n</a></td><td>style</td></tr>'
        for ref in ["JN00041-19", "", "JN00043-19", "JN00042-19", "JN00043-19", "JN00050-19", "JN00044-19"]
    )
)


def grid_page(header, parties, events):
    head = "".join(
        f'<tr><td class="label">{label}</td><td class="value">{value}</td></tr>' for label, value in header
    )
    party = "".join(
        '<tr class="party-row">' + "".join(f"<td>{c}</td>" for c in cells) + "</tr>" for cells in parties
    )
    event = "".join('<tr class="event-row">' + "".join(f"<td>{c}</td>" for c in cells) + "</tr>" for cells in events)
    return (
        "<!DOCTYPE html><!-- note --><html><head><title>t</title><script>var x='<table id=grdParties>';</script></head>"
        f'<body><div id="caseHeader"><table>{head}</table></div>'
        f'<table id="grdParties"><tr><th>Party</th><th>Type</th><th>Attorney</th></tr>{party}</table>'
        f'<table id="grdEvents"><tr><th>Date</th><th>Event</th></tr>{event}</table></body></html>'
    )


def block_page(ref, style, meta, parties, events):
    terms = "".join(f"<dt>{t}</dt><dd>{d}</dd>" for t, d in meta)
    party = "".join(
        f'<div class="party" data-role="{role}"><span class="party-name">{name}</span><ul class="attorneys">'
        + "".join(f"<li>{line}</li>" for line in lines)
        + "</ul></div>"
        for role, name, lines in parties
    )
    return (
        f'<html><body><main><div class="case-detail" data-case-number="{ref}"><h1 class="case-style">{style}</h1>'
        f'<dl class="case-meta">{terms}</dl><section class="parties">{party}</section>'
        f'<section class="events">{"".join(events)}</section></div></main></body></html>'
    )


def block_event(date, description, location=None):
    place = "" if location is None else f'<span class="event-loc">{location}</span>'
    return (
        f'<div class="event"><span class="event-date">{date}</span>'
        f'<span class="event-desc">{description}</span>{place}</div>'
    )


def card_page(refs):
    cards = "".join(f'<div class="result-card" data-case-number="{r}"><span>s</span></div>' for r in refs)
    return f'<html><body><section class="results">{cards}<div class="result-card">no number</div></section></body></html>'


GRID_PAGES = {
    "results_1.html": GRID_RESULTS,
    "JN00041-19.html": grid_page(
        [
            ("Case Number:", "JN00041-19"),
            ("Case Name:", "Petra &amp; Sons against Quill"),
            ("Filed:", "11/2/2019"),
            ("Type:", "Lease"),
            ("Status:", "Stayed"),
            ("Status:", "Reopened"),
            ("Court:", "Upper Circuit"),
        ],
        [
            ("Petra &amp; Sons", "Claimant", "Dorn, Ivo K. Sr."),
            ("Quill", "Respondent", "&nbsp;"),
            ("Harbor Trust", "Witness", "Abel Zorn"),
        ],
        [("12/01/2019<br>Annex 7", "Papers checked"), ("only one cell",)],
    ),
    "JN00042-19.html": grid_page(
        [("Case Number", "JN00042-19"), ("Style", "Matter of Wim"), ("Date Filed", "7/19/18"), ("Case Type", "Name change")],
        [("Wim", "Claimant", "Unrepresented"), ("Nobody", "Respondent", "<br>None<br>"), ("two", "cells")],
        [],
    ),
    "JN00043-19.html": grid_page(
        [("Case Number:", "JN00043-19"), ("Style:", "Hollis over Brandt"), ("Date Filed:", "October 23, 2019")],
        [("Hollis", "Claimant", "Marsh, Edda<br>Oakes, Rolf T. II"), ("Brandt", "Respondent", "van Loon, Piet")],
        [
            ("10/30/2019<br>Annex 2", "Call"),
            ("11/06/2019\n  <br> Annex\n 2", "Second <i>Call</i>"),
            ("no date yet", "Trial — Bench"),
        ],
    ),
    # No header at all: still a case.
    "JN00044-19.html": "<html><body><p>moved to another building</p></body></html>",
    "JN00045-19.html": grid_page([("Case Number:", "JN00045-19")], [("x", "y", "Not Listed")], []),
}

BLOCK_PAGES = {
    "results_1.html": card_page(["SR-012-X", "SP-0030-K", "SR-012-X"]),
    "results_2.html": card_page(["SR-013-Y", "SR-012-X", " "]),
    "SR-012-X.html": block_page(
        "SR-012-X",
        "Lund Mills and Tarn",
        [("Date Filed", "2021-09-30"), ("Case Type", "Easement"), ("Status", "Pending"), ("Court", "Second Bench")],
        [("Claimant", "Lund Mills", ["Greta Anna Sol", "Pro Se"]), ("Respondent", "Tarn", [])],
        [block_event("2021-10-05", "Reply", "by post")],
    ),
    "SP-0030-K.html": block_page(
        "",
        "In the matter of Vik",
        [("Filed", "08-15-2021"), ("Type", "Guardianship")],
        [("Claimant", "Vik", ["Not Represented"])],
        [
            block_event("2021-08-20<br>Chamber C, East", "Interview"),
            block_event("2021-09-01<br>Chamber C, East", "Report"),
        ],
    ),
    "SR-013-Y.html": block_page(
        "SR-013-Y",
        "Ness v. Holm &amp; Co.",
        [("Filed", "May 4, 2021"), ("Type", "Wages"), ("Status", "Pending")],
        [
            ("Claimant", "Ness", ["Tor E. Bakke Jr.", "Sun-Hee Cho"]),
            ("Respondent", "Holm", ["Ada D'Arcy", "Unrepresented"]),
            ("Intervenor", "Guild", ["Leo Finch IV"]),
        ],
        [
            block_event("2021-06-11", "Disclosure", ""),
            block_event("2021-07-02", "Mediation", "Chamber 2B"),
            block_event("2021-07-30", "Order"),
        ],
    ),
}

_J, _S = "Juniper County", "Sorrel County"
_PETRA = (_J, "JN00041-19", "Petra & Sons against Quill", "2019-11-02", "Lease", "Reopened", "Upper Circuit")
_CHECKED = ("2019-12-01 — Papers checked [Annex 7]", "")
_HOLLIS = (_J, "JN00043-19", "Hollis over Brandt", "2019-10-23", "", "", "Juniper Circuit")
_CALLS = ("2019-10-30 — Call [Annex 2]", "2019-11-06 — Second Call [Annex 2]; no date yet — Trial — Bench")
_NESS = (_S, "SR-013-Y", "Ness v. Holm & Co.", "2021-05-04", "Wages", "Pending", "Sorrel Bench")
_ORDERED = ("2021-06-11 — Disclosure", "2021-07-02 — Mediation [Chamber 2B]; 2021-07-30 — Order")

EXPECTED = [
    (*_PETRA, "Ivo", "K.", "Dorn", "Sr.", "Claimant", *_CHECKED),
    (*_PETRA, "Abel", "", "Zorn", "", "Witness", *_CHECKED),
    (_J, "JN00042-19", "Matter of Wim", "2018-07-19", "Name change", "", "Juniper Circuit", "", "", "", "", "", "", ""),
    (*_HOLLIS, "Edda", "", "Marsh", "", "Claimant", *_CALLS),
    (*_HOLLIS, "Rolf", "T.", "Oakes", "II", "Claimant", *_CALLS),
    (*_HOLLIS, "Piet", "", "van Loon", "", "Respondent", *_CALLS),
    (_J, "JN00044-19", "", "", "", "", "Juniper Circuit", "", "", "", "", "", "", ""),
    (_S, "SP-0030-K", "In the matter of Vik", "2021-08-15", "Guardianship", "", "Sorrel Bench", "", "", "", "", "",
     "2021-08-20 — Interview [Chamber C, East]", "2021-09-01 — Report [Chamber C, East]"),
    (_S, "SR-012-X", "Lund Mills and Tarn", "2021-09-30", "Easement", "Pending", "Second Bench",
     "Greta", "Anna", "Sol", "", "Claimant", "2021-10-05 — Reply [by post]", ""),
    (*_NESS, "Tor", "E.", "Bakke", "Jr.", "Claimant", *_ORDERED),
    (*_NESS, "Sun-Hee", "", "Cho", "", "Claimant", *_ORDERED),
    (*_NESS, "Ada", "", "D'Arcy", "", "Respondent", *_ORDERED),
    (*_NESS, "Leo", "", "Finch", "IV", "Intervenor", *_ORDERED),
]


def pages_frame(spark):
    rows = [
        (county["key"], key, html)
        for county, pages in ((GRID, GRID_PAGES), (BLOCK, BLOCK_PAGES))
        for key, html in pages.items()
    ]
    return spark.createDataFrame(rows, "county_key string, page_key string, html string")
