"""Column expressions: parsing, binning, flags. All stay inside codegen."""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from paddock.functions import vocab as V
from paddock.functions.farm import fingerprint

# A number at the start of the text, as a lenient reader would take it.
LEADING_NUMBER = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
EDGE_SPACE = r"(?U)^[\s\uFEFF]+|[\s\uFEFF]+$"
GAP = r"(?U)[\s\uFEFF]+"


def flag(condition: Column) -> Column:
    """TRUE only where the condition holds; unknown counts as FALSE."""
    return F.coalesce(condition, F.lit(False))


def one_hot(source: Column, names: dict[str, str]) -> list[Column]:
    return [flag(source == label).alias(name) for label, name in names.items()]


def in_band(source: Column, low, high) -> Column:
    if low is None:
        return source <= high
    if high is None:
        return source >= low
    return source.between(low, high)


def ratio(top: Column, bottom: Column) -> Column:
    """Division that yields NULL on an empty denominator."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value evaluated once per row.

    Inside array functions the optimizer would otherwise put the expression in
    place of every use and evaluate it per element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def is_win(place: Column = None) -> Column:
    return (F.col("finish_place") if place is None else place) == 1


# ---- text -------------------------------------------------------------------
def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def zero_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(0).cast("long"))


def _trimmed(text: Column) -> Column:
    return F.regexp_replace(text, EDGE_SPACE, "")


def single_amount(text: Column, kind: str = "double") -> Column:
    """An amount stored as text; a list of amounts or any other text is NULL."""
    return text.try_cast(kind)


def prize_value(text: Column) -> Column:
    """Number in front of a prize text such as ``27800 PLN``; 0 if there is none.

    The text is split on white space, so a space used as thousands separator
    ends the number, and only the first comma is read as a decimal point.
    """
    head = F.get(F.split(_trimmed(text), GAP), F.lit(0))
    dotted = F.regexp_replace(head, r"^([^,]*),", "$1.")
    return F.coalesce(
        F.regexp_extract(dotted, LEADING_NUMBER, 0).try_cast("double"), F.lit(0.0)
    )


def prize_currency(text: Column) -> Column:
    word = F.get(F.split(_trimmed(text), GAP), F.lit(1))
    return F.lower(F.coalesce(blank_to_null(word), F.lit("pln")))


def fx_rate(currency: Column, compat: bool = False) -> Column:
    """PLN per unit of a lower-cased currency, 1 where it is unknown.

    With ``compat`` the table keeps its mixed-case keys, which a lower-cased
    currency can never meet, so those currencies count as unknown.
    """
    rates = V.FX_TO_PLN if compat else {k.lower(): v for k, v in V.FX_TO_PLN.items()}
    table = F.create_map(*[F.lit(x) for pair in rates.items() for x in pair])
    return F.coalesce(F.try_element_at(table, currency), F.lit(1.0))


def prize_in_pln(text: Column, compat: bool = False) -> Column:
    """PLN value of a prize text; an absent or empty text is worth 0."""
    value = prize_value(text) * fx_rate(prize_currency(text), compat)
    return F.when(F.length(text) > 0, value).otherwise(F.lit(0.0))


def payout(text: Column, code: str) -> Column:
    """Amount that follows a bet code, e.g. ``ZWC 12,50``; NULL without a match."""
    found = F.regexp_extract(text, code + r"\s*([0-9]+,[0-9]+)", 1)
    return F.replace(found, F.lit(","), F.lit(".")).try_cast("double")


@functools.cache
def accent_table() -> tuple[str, str]:
    """(from, to) for ``translate``: every letter that decomposes into a base and
    combining marks, then the marks themselves, which have no counterpart and
    are deleted."""
    marks = "".join(map(chr, range(0x300, 0x370)))
    marked, plain = [], []
    for code in range(0xC0, 0xD800):
        base, *rest = unicodedata.normalize("NFD", chr(code))
        if rest and all(c in marks for c in rest):
            marked.append(chr(code))
            plain.append(base)
    return "".join(marked) + marks, "".join(plain)


def unaccent(text: Column, lenient: bool = False) -> Column:
    """Strip diacritics; NULL becomes the empty text.

    Stroke letters (``ł``) do not decompose and stay as they are unless
    ``lenient``.
    """
    marked, plain = accent_table()
    if lenient:
        marked, plain = V.STROKE_LETTERS + marked, V.STROKE_PLAIN + plain
    return F.translate(F.coalesce(text, F.lit("")), marked, plain)


def file_tag(name: Column, fallback: Column) -> Column:
    """Time stamp inside a cleaned master file's name, else the fallback.

    Accepts the compact form (``20250803T1015_30Z``) and the dashed ISO form
    that the shard merge writes (``2025-08-03T10_15_30_123Z``).
    """
    stamp = r"CLEANED_MASTERFILE_[^_]+_([0-9]{4}-?[0-9]{2}-?[0-9]{2}T[0-9_]+Z)\.ndjson$"
    return F.coalesce(blank_to_null(F.regexp_extract(name, stamp, 1)), fallback)


def record_text(horse: Column, race: Column, order: Column) -> Column:
    """Readable form of a starter's key; missing parts become empty text."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (horse, race, order)]
    return F.concat_ws("_", *parts)


def record_key(horse: Column, race: Column, order: Column) -> Column:
    """FARM_FINGERPRINT of the readable form: the key of tables made elsewhere."""
    return fingerprint(record_text(horse, race, order))


# Fixed value: the collation that ignores case, accents (strokes too) and blanks at the end.
LENIENT = "UNICODE_CI_AI_RTRIM"


def name_key(text: Column, strip_initial: bool = False, fold: bool = False, lenient: bool = False) -> Column:
    """Case- and edge-insensitive join key for a person's or horse's name. ``fold``
    takes the diacritics out; ``lenient`` leaves the name and compares it by a collation
    that ignores them, by which keys are also hashed and sorted."""
    key = F.trim(text) if lenient else F.lower(F.trim(text))
    if strip_initial:
        key = F.trim(F.regexp_replace(key, r"\s+\p{L}\.$", ""))
    if lenient:
        return F.collate(key, LENIENT)
    return F.when(text.isNotNull(), unaccent(key, lenient=True)) if fold else key


# ---- bins -------------------------------------------------------------------
def distance_bucket(metres: Column) -> Column:
    out = F
    for label, (low, high) in V.DISTANCE_BUCKETS.items():
        out = out.when(in_band(metres, low, high), label)
    return out.otherwise("unknown")


def clamp_to_null(value: Column, low=None, high=None) -> Column:
    """Keep a value inside its plausible range, NULL it outside."""
    return F.when(in_band(value, low, high), value)


def temp_bucket(celsius: Column) -> Column:
    """Whole-degree bins; values between two bins (22.5) stay unknown."""
    return (
        F.when(celsius > 30, "temp_gt_30")
        .when(celsius.between(23, 30), "temp_23_30")
        .when(celsius.between(15, 22), "temp_15_22")
        .when(celsius.between(7, 14), "temp_7_14")
        .when(celsius <= 6, "temp_le_6")
        .otherwise("temp_unknown")
    )


def weather_flags(weather: Column, as_int: bool = False) -> list[Column]:
    out = []
    for name, words in V.WEATHER_FLAGS.items():
        hit = flag(weather.isin(words))
        out.append((hit.cast("int").cast("long") if as_int else hit).alias(name))
    return out


def surface_category(surface: Column) -> Column:
    return F.when(surface.isin(V.SURFACE_CATEGORIES), surface).otherwise("other")


def prize_bucket(total: Column) -> Column:
    out = F.when(total == 0, "p_0")
    for edge, label in V.PRIZE_BUCKETS:
        out = out.when(total <= edge, label)
    return out.otherwise("p_16000+")


def rest_bucket(days: Column) -> Column:
    out = F
    for edge, label in V.REST_BUCKETS:
        out = out.when(days < edge, label)
    return out.otherwise("other")


def style_ease_score(style: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in V.STYLE_EASE.items() for x in pair])
    return F.try_element_at(table, style).cast("long")


def band_flags(metres: Column, bands=V.RACE_BANDS, prefix="dist_") -> list[Column]:
    return [flag(in_band(metres, *edge)).alias(prefix + name) for name, edge in bands.items()]


def outcome_flags(place: Column) -> list[Column]:
    return [
        flag(place == 1).alias("is_win"),
        flag(place <= 3).alias("is_place"),
        flag(place <= 5).alias("is_paid"),
    ]


# ---- probability arrays -----------------------------------------------------
def normalize_probs(probs: Column, max_label: int = 8) -> Column:
    """Keep labels up to ``max_label``, rescale them to sum to 1, sort by label.

    ``probs`` is an array of structs ``label`` (text or number), ``prob``.
    Works inside the row, so no rows are exploded or shuffled.
    """
    kept = F.filter(probs, lambda p: p["label"].try_cast("long") <= max_label)
    total = F.aggregate(kept, F.lit(0.0), lambda acc, p: acc + p["prob"].cast("double"))
    scaled = F.transform(
        kept,
        lambda p: F.struct(
            p["label"].try_cast("long").alias("label"),
            ratio(p["prob"], total).alias("prob"),
        ),
    )
    return F.array_sort(scaled)


def prob_at(probs: Column, position: int) -> Column:
    """Probability at a position, NULL when fewer places survive."""
    return F.get(probs, F.lit(position))["prob"]
