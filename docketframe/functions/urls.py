"""Page URLs and the page key derived from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketframe.functions.text import bind

_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)"


def page_key(url: Column) -> Column:
    """File name of a page: last path segment, ``index`` if there is none, always ending in ``.html``.

    Query, fragment and path parameters are not part of it.
    """
    path = F.regexp_replace(F.regexp_extract(url, _PATH, 1), r";[^/]*$", "")
    name = F.substring_index(F.regexp_replace(path, r"(?:/\.?)+$", ""), "/", -1)
    return bind(name, lambda name: F.when(name == "", "index.html").when(name.endswith(".html"), name).otherwise(F.concat(name, F.lit(".html"))))


def search_url(base_url: Column, page: Column) -> Column:
    return F.concat(base_url, F.lit("/Search/"), page)


def case_url(base_url: Column, case_ref: Column) -> Column:
    return F.concat(base_url, F.lit("/Case/"), case_ref)
