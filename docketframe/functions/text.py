"""Whitespace, dates, personal names, stacked cells, event text.

Every function takes and returns a ``Column`` built from built-in expressions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points Unicode calls white space, as a regex class
# body. Zero-width space and the byte order mark are not among them.
SPACES = (
    r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
# The same class, arranged so that a usual character is ruled out in two steps: low ones by a table, others by one range.
_LOW = "".join(rf"\x{{{code:x}}}" for code in (*range(0x9, 0xE), *range(0x1C, 0x21), 0x85, 0xA0))
_SPACE = rf"[{_LOW}[\x{{1680}}-\x{{3000}}&&[\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]]]"
# Runs that differ from one plain space; single spaces, the usual case, are left alone.
_UNTIDY_RUN = f"{_SPACE}(?:{_SPACE}+|(?<! ))"
# The same without line breaks.
_INLINE = _SPACE.replace(r"\x{a}", "").replace(r"\x{d}", "")
_UNTIDY_INLINE_RUN = f"{_INLINE}(?:{_INLINE}+|(?<! ))"

# What portals print where no attorney is of record.
PLACEHOLDERS = [
    "",
    "pro se",
    "prose",
    "pro-se",
    "pro per",
    "n/a",
    "na",
    "none",
    "unrepresented",
    "not represented",
    "no attorney",
]

# Name suffixes, as compared after dots are dropped and case is folded.
WORD_SUFFIXES = ["jr", "sr", "esq"]
ROMAN_SUFFIXES = ["ii", "iii", "iv", "v"]

# Month names; the first three letters are the abbreviation.
MONTHS = [
    "january",
    "february",
    "march",
    "april",
    "may",
    "june",
    "july",
    "august",
    "september",
    "october",
    "november",
    "december",
]
_MARK = "\ufdd0"  # a noncharacter, never part of text
_LONG_OR_SHORT = "|".join(f"{month[:3]}|{month}" for month in MONTHS)
_SHORT = "|".join(month[:3] for month in MONTHS)
_MONTH_NUMBERS = {month[:3]: str(number) for number, month in enumerate(MONTHS, 1)}

_M = "1[0-2]|0?[1-9]"
_D = "3[01]|[12][0-9]|0[1-9]| ?[1-9]"
_Y = "(?!0000)[0-9]{4}"
# The seven written forms by shape, in one expression: the first that fits counts. Two-digit years: 69-99 belong to the
# 1900s, 00-68 to the 2000s.
_DATE_FORMS = (
    "^(?:"
    f"({_Y})-({_M})-({_D})"
    f"|({_M})([/-])({_D})\\5({_Y})"
    f"|({_M})/({_D})/(?:(69|[7-9][0-9])|([0-5][0-9]|6[0-8]))"
    f"|((?i:{_LONG_OR_SHORT})) ({_D}), ({_Y})"
    f"|({_D}) ((?i:{_SHORT})) ({_Y})"
    ")$"
)
# Behind the first mark: year, year of the 1900s, year of the 2000s, month, named month, day.
_DATE_PARTS = f"{_MARK}$1$7$14$17{_MARK}$10{_MARK}$11{_MARK}$2$4$8{_MARK}$12$16{_MARK}$3$6$9$13$15"

# A suffix token may carry dots anywhere and any case: "Jr.", "J.R.", "III".
_TOKEN = r"(?i:\.*(?:{})\.*)".format(
    "|".join(r"\.*".join(word) for word in WORD_SUFFIXES + ROMAN_SUFFIXES)
)
# A cleaned name, by the first alternative that fits. With a comma: what is
# before it is the last name; the suffix stands after a further comma, or is the
# last given name. Without: the last word is the last name, with the suffix
# behind or before it.
_NAME_FORMS = (
    "^(?:"
    f"([^,]*?) ?, ?(?:(.*?) ?, ?({_TOKEN})|(?:(.*) )?({_TOKEN})|(.*))"
    f"|(?:(.*) )?([^ ]+) ({_TOKEN})"
    f"|(?:(.*) )?({_TOKEN}) ([^ ]+)"
    "|(?:(.*) )?([^ ]+)"
    ")$"
)
_NAME_PARTS = f"$1$8$12$14{_MARK}$2$4$6$7$10$13{_MARK}$3$5$9$11"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it.

    Without it every use repeats the whole expression in the plan, and long
    chains outgrow what can be compiled.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def clean_text(value: Column) -> Column:
    """White space runs become one space, ends are trimmed, null becomes ''."""
    return F.trim(F.regexp_replace(F.coalesce(value, F.lit("")), _UNTIDY_RUN, " "))


def clean_text_sql(value: str) -> str:
    """:func:`clean_text` as SQL text."""
    return f"trim(regexp_replace(coalesce({value}, ''), r'{_UNTIDY_RUN}', ' '))"


def _folded(text: Column) -> Column:
    return F.lower(F.replace(text, F.lit("."), F.lit("")))


def is_placeholder(value: Column) -> Column:
    """True where the text says that there is no attorney."""
    return _folded(clean_text(value)).isin(PLACEHOLDERS)


def names_nobody(value: Column) -> Column:
    """True where a listed line yields no attorney: a placeholder, or a lone comma (all name parts empty)."""
    return bind(clean_text(value), lambda text: _folded(text).isin(PLACEHOLDERS) | (text == ","))


def normalize_date(value: Column) -> Column:
    """Seven written forms to ISO ``yyyy-MM-dd``; any other text is returned cleaned, as it is.

    A form is recognized by shape; only a real calendar date is then accepted.
    """
    return normalize_clean_date(clean_text(value))


def normalize_clean_date(value: Column) -> Column:
    """:func:`normalize_date` of text that is clean already, as a line of :func:`split_stacked` is."""

    def iso(text: Column) -> Column:
        rewritten = bind(F.regexp_replace(text, _DATE_FORMS, _DATE_PARTS), lambda form: F.when(F.startswith(form, F.lit(_MARK)), as_date(form)))
        return F.coalesce(rewritten, text)

    def as_date(form: Column) -> Column:
        numbers = F.create_map(*[F.lit(part) for item in _MONTH_NUMBERS.items() for part in item])

        def joined(parts: Column) -> Column:
            year, late, early, month, name, day = (F.get(parts, F.lit(at)) for at in range(1, 7))
            century = F.when(late != "", "19").when(early != "", "20").otherwise("")
            numbered = F.when(name == "", month).otherwise(F.try_element_at(numbers, F.lower(F.substring(name, 1, 3))))
            return F.concat(century, year, late, early, F.lit("-"), numbered, F.lit("-"), F.ltrim(day))

        return bind(F.split(form, _MARK), joined).try_cast("date").cast("string")

    return bind(value, iso)


def norm_suffix(token: Column) -> Column:
    """``Jr.``, ``Sr.``, ``Esq.``, ``II`` ... for a suffix token, '' for any other."""
    written = {word: f"{word.capitalize()}." for word in WORD_SUFFIXES} | {n: n.upper() for n in ROMAN_SUFFIXES}
    known = F.create_map(*[F.lit(part) for item in written.items() for part in item])
    return F.coalesce(F.try_element_at(known, _folded(F.coalesce(token, F.lit("")))), F.lit(""))


def split_name(value: Column) -> Column:
    """``Last, First Middle Suffix`` or ``First Middle Last Suffix`` to a struct of four strings."""
    marked = F.regexp_replace(clean_text(value), _NAME_FORMS, _NAME_PARTS)

    def parts(name: Column) -> Column:
        given = F.coalesce(F.get(name, F.lit(1)), F.lit(""))
        first = F.substring_index(given, " ", 1)
        return F.struct(
            first.alias("first_name"),
            F.substring(given, F.length(first) + 2, F.length(given)).alias("middle_name"),
            F.get(name, F.lit(0)).alias("last_name"),
            norm_suffix(F.get(name, F.lit(2))).alias("suffix"),
        )

    return bind(F.split(marked, _MARK), parts)


def split_stacked(value: Column) -> Column:
    """A cell of several lines to ``struct<date, location>``: first line, and the others joined by a space."""
    inline = F.regexp_replace(F.coalesce(value, F.lit("")), _UNTIDY_INLINE_RUN, " ")
    tidy = F.btrim(F.regexp_replace(inline, r" ?[\r\n][ \r\n]*", "\n"), F.lit(" \n"))

    def parts(lines: Column) -> Column:
        date = F.substring_index(lines, "\n", 1)
        others = F.substring(lines, F.length(date) + 2, F.length(lines))
        return F.struct(date.alias("date"), F.replace(others, F.lit("\n"), F.lit(" ")).alias("location"))

    return bind(tidy, parts)


def format_event(event: Column) -> Column:
    """``<date> — <description> [<location>]``, without dangling dashes or empty brackets."""
    date, description = (F.coalesce(event[part], F.lit("")) for part in ("date", "description"))
    whole = F.concat(date, F.lit(" — "), description)
    dangling = (date == "") | (description == "")
    for end in (" ", "—"):
        dangling = dangling | F.startswith(date, F.lit(end)) | F.endswith(description, F.lit(end))
    text = F.when(dangling, F.btrim(whole, F.lit(" —"))).otherwise(whole)
    place = F.when(event["location"] != "", F.concat(F.lit(" ["), event["location"], F.lit("]"))).otherwise("")
    return clean_text(F.concat(text, place))


def label_key(value: Column) -> Column:
    """A header label as a lookup key. A blank before the colon stays, so such a label matches nothing."""
    return F.lower(F.rtrim(clean_text(value), F.lit(":")))


def zero_pad(number: Column, width: Column) -> Column:
    """Digits padded to ``width``, the sign kept in front, nothing ever cut off."""
    digits = F.abs(number).cast("string")
    sign = F.when(number < 0, "-").otherwise("")
    room = F.greatest(width - F.length(sign), F.length(digits))
    return F.concat(sign, F.lpad(digits, room, F.lit("0")))
