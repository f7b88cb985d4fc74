"""Schemas and the contractual output columns."""

from __future__ import annotations

# The output header, in contractual order. The left side is the
# name used inside the jobs, the right side the name in the exported table.
OUTPUT_COLUMNS = {
    "county": "County",
    "case_number": "Case Number",
    "case_name": "Case Name",
    "filing_date": "Filing Date",
    "case_type": "Type",
    "status": "Status",
    "court": "Court",
    "first_name": "First Name",
    "middle_name": "Middle Name",
    "last_name": "Last Name",
    "suffix": "Suffix",
    "party_role": "Party (Plaintiff/Defendant)",
    "events_primary": "Events / Hearings",
    "events_cont": "Events / Hearings (cont.)",
}

ROW_COLUMNS = list(OUTPUT_COLUMNS)
SORT_COLUMNS = ["county", "case_number", "last_name", "first_name"]
CASE_SCALARS = ["county", "case_number", "case_name", "filing_date", "case_type", "status", "court"]

ATTORNEY_DDL = "struct<first_name:string,middle_name:string,last_name:string,suffix:string>"
PARTIES_DDL = f"array<struct<name:string,role:string,attorneys:array<{ATTORNEY_DDL}>>>"
EVENTS_DDL = "array<struct<date:string,description:string,location:string>>"

# Ordinals that carry first-seen order: the county's place in the run, the
# results page's place in the county, the reference's place on that page.
CASES_DDL = (
    "county_key string, county string, case_ref string, case_number string, case_name string, "
    "filing_date string, case_type string, status string, court string, "
    f"parties {PARTIES_DDL}, events {EVENTS_DDL}, county_ord int, page_ord int, ref_pos int"
)

# Parties as they come off a page: attorney lines are still raw text.
LISTED_PARTIES_DDL = "array<struct<name:string,role:string,lines:array<string>>>"
PAIRS_DDL = "array<struct<label:string,value:string>>"

LANDED_DDL = "county_key string, kind string, page_key string, html string"
COUNTIES_DDL = (
    "county_key string, county_ord int, county string, adapter string, base_url string, court string"
)
SEARCH_PAGES_DDL = "county_key string, page_ord int, page string"
SPECS_DDL = (
    "county_key string, spec_ord bigint, pattern string, template string, start bigint, end bigint, "
    "width int, suffixes array<string>, per_suffix_ranges map<string,struct<start:bigint,end:bigint>>, "
    "extra map<string,string>"
)
DONE_DDL = "n string"
