"""Secrets in texts, with DataFrame functions only.

Base kinds are found by pattern: ``assign`` (a name of a secret, a separator and a value), ``access`` (key ids) and
``hex`` (long hexadecimal runs), leftmost and without overlap within a kind. The method adds ``entropy``: runs of token
characters over which a window of ``WINDOW`` characters slides. Character counts of the window are kept and changed by
the two characters that leave and enter, and the Shannon entropy is changed with them. Base spans, examples and sequences
of the alphabet are cut out of a run first; each stretch that is left, of ``WINDOW`` characters or more, is a secret if some
window reaches the bound of its character class. Stretches the allow list knows (plain words, digits, UUIDs, paths and
dotted names) are not added.

Places are code points, end exclusive. A null text counts as empty and has no spans; very long texts are scanned whole.
Every row is judged by itself, so empty tables, repeated rows and other columns change nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed patterns. Letters of the names are spelt in both cases.
NAMES = (
    "(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
)
ASSIGN_HEAD = NAMES + r"""["']?\x20*[:=]\x20*["']?"""
ASSIGN_VALUE = "[A-Za-z0-9+/_.=-]+"
ASSIGN = ASSIGN_HEAD + ASSIGN_VALUE
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
#: Least characters of an assigned value.
ASSIGN_LEAST = 6

WINDOW = 20
RUN = f"[A-Za-z0-9+/_-]{{{WINDOW},}}"
#: Character classes, first match first, with the bits a window must reach. A window of 20 has at most 4.32.
CLASSES = (("hex", "[0-9a-fA-F]+", 3.1), ("token", "[A-Za-z0-9]+", 3.8), ("mixed", ".+", 3.9))
#: Stretches that are no secrets. No group is repeated: the pattern engine goes one call deeper for each repetition.
ALLOWED = (
    r"[A-Za-z/_-]+",
    r"[0-9](?:[0-9/_-]*[0-9])?",
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
)
#: Parts of runs that are no secrets.
PLAIN = "[eE]xample|EXAMPLE|abcdefghij|ABCDEFGHIJ|0123456789"
KINDS = ("assign", "access", "hex", "entropy")


def _found(text: Column, pattern: str) -> Column:
    """Matches as structs of start, end and the matched text.

    Each piece runs from the end of the match before to the end of its own match, so lengths give the places.
    """
    pieces = F.regexp_extract_all(text, F.lit(rf"\G(?s:.*?)(?:{pattern})"), F.lit(0))
    found = F.transform(pieces, lambda piece: F.regexp_extract(piece, rf"\A(?s:.*?)({pattern})\z", 1))
    none = F.lit([]).cast("array<struct<start:long,end:long,found:string>>")
    start = F.struct(F.lit(0).cast("long").alias("at"), none.alias("spans"))

    def step(state: Column, pair: Column) -> Column:
        end = state["at"] + F.length(pair["piece"])
        span = F.struct((end - F.length(pair["found"])).alias("start"), end.alias("end"), pair["found"].alias("found"))
        return F.struct(end.cast("long").alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    pairs = F.arrays_zip(pieces.alias("piece"), found.alias("found"))
    return F.when(F.size(pieces) > 0, F.aggregate(pairs, start, step, lambda state: state["spans"])).otherwise(none)


def _bits(count: Column) -> Column:
    """count * log2(count), 0 for 0."""
    return F.when(count > 1, count * F.log2(count)).otherwise(0.0)


def _bound(value: Column, use) -> Column:
    """``use`` of a variable that holds ``value``, so that it is worked out once and not for every element."""
    return F.get(F.transform(F.array(value), use), 0)


def window_entropy(run: Column) -> Column:
    """The highest Shannon entropy, in bits, of a window that slides over ``run``."""
    chars = F.filter(F.split(run, ""), lambda c: c != "")

    def coded(chars: Column) -> Column:
        codes = lambda alphabet: F.transform(chars, lambda c: F.array_position(alphabet, c).cast("int"))
        return _bound(F.array_distinct(chars), lambda alphabet: _bound(codes(alphabet), lambda codes: _slid(codes, F.size(alphabet))))

    return _bound(chars, coded)


def _slid(codes: Column, letters: Column) -> Column:
    """``window_entropy`` of characters given as 1 to ``letters``."""
    start = F.struct(F.array_repeat(F.lit(0), letters).alias("counts"), F.lit(0.0).alias("bits"), F.lit(0.0).alias("best"))

    def step(state: Column, at: Column) -> Column:
        enters = F.element_at(codes, at)
        leaves = F.when(at > WINDOW, F.element_at(codes, F.greatest(at - WINDOW, F.lit(1)))).otherwise(0)
        same = enters == leaves
        more = F.element_at(state["counts"], enters)
        less = F.element_at(state["counts"], F.greatest(leaves, F.lit(1)))
        grown = _bits(more + 1) - _bits(more)
        shrunk = F.when(leaves > 0, _bits(less - 1) - _bits(less)).otherwise(0.0)
        bits = F.when(same, state["bits"]).otherwise(state["bits"] + grown + shrunk)
        counts = F.transform(
            state["counts"],
            lambda count, i: count + F.when(i + 1 == enters, 1).otherwise(0) - F.when(i + 1 == leaves, 1).otherwise(0),
        )
        entropy = F.when(at >= WINDOW, F.log2(F.lit(float(WINDOW))) - bits / WINDOW).otherwise(0.0)
        return F.struct(counts.alias("counts"), bits.alias("bits"), F.greatest(state["best"], entropy).alias("best"))

    return F.aggregate(F.sequence(F.lit(1), F.size(codes)), start, step, lambda state: state["best"])


def _stretches(span: Column, base: Column) -> Column:
    """What is left of a run without the base spans and the plain parts, as spans of at least ``WINDOW`` characters."""
    run, length = span["found"], F.length(span["found"])
    place = lambda start, end: F.struct(start.cast("long").alias("start"), end.cast("long").alias("end"))
    none = F.lit([]).cast("array<struct<start:long,end:long>>")
    over = F.filter(base, lambda b: (b["start"] < span["end"]) & (span["start"] < b["end"]))
    within = F.transform(over, lambda b: place(b["start"] - span["start"], b["end"] - span["start"]))
    plain = F.when(run.rlike(PLAIN), F.transform(_found(run, PLAIN), lambda p: place(p["start"], p["end"]))).otherwise(none)
    cuts = F.array_sort(F.concat(within, plain, F.array(place(length, length))))
    start = F.struct(F.lit(0).cast("long").alias("at"), none.alias("left"))

    def step(state: Column, cut: Column) -> Column:
        long = cut["start"] - state["at"] >= WINDOW
        left = F.when(long, F.concat(state["left"], F.array(place(state["at"], cut["start"])))).otherwise(state["left"])
        return F.struct(F.greatest(state["at"], cut["end"]).alias("at"), left.alias("left"))

    def taken(chars: Column) -> Column:
        def of(part: Column) -> Column:
            found = F.array_join(F.slice(chars, (part["start"] + 1).cast("int"), (part["end"] - part["start"]).cast("int")), "")
            return F.struct((span["start"] + part["start"]).alias("start"), (span["start"] + part["end"]).alias("end"), found.alias("found"))

        return _bound(F.aggregate(cuts, start, step, lambda state: state["left"]), lambda left: F.transform(left, of))

    whole = ~F.exists(base, lambda b: (b["start"] < span["end"]) & (span["start"] < b["end"])) & ~run.rlike(PLAIN)
    return F.when(whole, F.array(span)).otherwise(_bound(F.split(run, ""), taken))


def _suspect(span: Column) -> Column:
    run = span["found"]
    bound = F.lit(99.0)
    for _, pattern, bits in reversed(CLASSES):
        bound = F.when(run.rlike(rf"\A{pattern}\z"), bits).otherwise(bound)
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | run.rlike(rf"\A(?:{pattern})\z")
    return F.when(allowed, False).otherwise(window_entropy(run) >= bound)


def find_secrets(documents: DataFrame) -> DataFrame:
    """doc_id and ``found``: kind, start, end and text of every span, by start and kind; and the base spans alone."""
    text = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    value_length = lambda span: F.length(F.regexp_extract(span["found"], rf"\A{ASSIGN_HEAD}({ASSIGN_VALUE})\z", 1))
    scanned = text.select(
        "doc_id",
        F.filter(_found(F.col("text"), ASSIGN), lambda span: value_length(span) >= ASSIGN_LEAST).alias("assign"),
        _found(F.col("text"), ACCESS).alias("access"),
        _found(F.col("text"), HEX).alias("hex"),
        _found(F.col("text"), RUN).alias("runs"),
    )
    base = F.concat("assign", "access", "hex")
    stretches = _bound(base, lambda base: F.flatten(F.transform("runs", lambda span: _stretches(span, base))))
    judged = scanned.select("doc_id", "assign", "access", "hex", F.filter(stretches, _suspect).alias("entropy"))

    def of_kind(order: int) -> Column:
        return F.transform(
            KINDS[order], lambda span: F.struct(span["start"], F.lit(order).alias("order"), span["end"], span["found"].alias("found"))
        )

    base_spans = F.array_sort(F.concat(*[of_kind(order) for order in range(3)]))
    spans = F.array_sort(F.concat(*[of_kind(order) for order in range(4)]))
    return judged.select("doc_id", *KINDS, base_spans.alias("base_spans"), spans.alias("found"))


def _line(spans: Column) -> Column:
    kinds = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["order"]), s["start"], s["end"])), ",")


def secret_report(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256, spans."""
    counts = [F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return find_secrets(documents).select(
        "doc_id", *counts, F.sha2(_line(F.col("base_spans")), 256).alias("base_sha256"), _line(F.col("found")).alias("spans")
    )
