"""Multi-value field standardisation (H8-H18) as Column expressions.

A field value is split into its values (H16), each value runs through the
field's ordered rule list (H18) and the results are re-joined (H17).  Every
rule is a ``Column -> Column`` function applied with its own ``transform`` over
the value array, so rules compose without duplicating expression trees and
everything stays JVM-side (no Python UDF).

The rule registry ``RULES`` maps a field to its rule list; users can add fields
or rules with plain Column functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kardex.functions import dates as D
from kardex.functions._util import as_col, let
from kardex.functions.text import (capwords, dedupe_phrase, nearest_term, replace_ampersand,
                                   strip, strip_chars, upper_except)

# Per-field delimiters.
DELIMITERS = {
    "production_type": "\r",
    "Language": ", ",
    "director": ", ",
    "release_broadcast_year": "; ",
    "record_date": "; ",
}

# Fixed value: delimiter pattern of free-text multi-value fields.
DELIMITER_PATTERN = r"\s*([,;/|]|\band\b|&|\r)\s*"

# Controlled-term maps (None = drop the value).
PRODUCTION_TYPE_TERMS = {
    "NEWSREEL": "NEWSREELS",
    "TITLES, BKGD, OUTS": "TITLES, BKGD, Overlays",
    "TITLES, BKGD, OVERLAYS": "TITLES, BKGD, Overlays",
    "TRIMS AND OUTS": "Trims and Outs",
    "MADE FOR TV MOVIES": "MADE FOR TV MOVIE",
    "MADE-FOR-TV": "MADE FOR TV MOVIE",
    "SILENT FILMS": "SILENT FILM",
    "FULL SILENT APERTURE 1.33:1": None,
    "SF": None,
    "SE": None,
}
LANGUAGE_TERMS = {
    "FR": "French",
    "ENG": "English",
    "PORTUGUESE FOR BRAZIL": "Portuguese",
    "UNKNOWN": "Undetermined",
    "?": "Undetermined",
    "": "Undetermined",
    "N/A": "No linguistic content",
    "NONE": "No linguistic content",
}
DIRECTOR_TERMS = {
    "NO DIRECTOR LISTED": "N/A",
    "N/A": "N/A",
    "NULL": "Unknown",
    "UNKNOWN": "Unknown",
    "": "Unknown",
}
# Production types kept in their own casing.
KEEP_CASE_TYPES = ["TITLES, BKGD, Overlays", "Trims and Outs"]
# Controlled language names for spelling correction.
LANGUAGES = [
    "Amharic", "Arabic", "Chinese", "Czech", "Danish", "Dutch", "English", "Ethiopic",
    "French", "German", "Hebrew", "Hindi", "Hungarian", "Indonesian", "Italian",
    "Japanese", "Korean", "Navajo", "No linguistic content", "Norwegian", "Persian",
    "Polish", "Portuguese", "Russian", "Spanish", "Swedish", "Thai", "Ukrainian",
    "Undetermined", "Vietnamese", "Yupik languages",
]
SPELLING_THRESHOLD = 0.2


def map_terms(c: Column, terms: dict, upper_key: bool = False) -> Column:
    """Controlled-term lookup; ``None`` targets drop the value (null)."""
    key = F.upper(c) if upper_key else c
    present = {k: v for k, v in terms.items() if v is not None}
    drop = [k for k, v in terms.items() if v is None]
    m = F.create_map(*[x for k, v in present.items() for x in (F.lit(k), F.lit(v))])
    mapped = F.coalesce(m[key], c)
    if drop:
        return F.when(key.isin(*drop), F.lit(None).cast("string")).otherwise(mapped)
    return mapped


def standard_language(c: Column) -> Column:
    """Drop "Intertitles", then snap to the nearest controlled name when
    the normalised Levenshtein distance is below 0.2; blank -> ``""``."""
    def snap(v):
        best = nearest_term(v, LANGUAGES)
        return (F.when(v == "", F.lit(""))
                 .when(best["dist"] < SPELLING_THRESHOLD, best["term"])
                 .otherwise(v))
    return let(strip(F.replace(c, F.lit("Intertitles"), F.lit(""))), snap)


# The patterns of the name rules below (credit, nickname, Roman
# numeral, care of, numbering, initials).
def credited_name(c: Column) -> Column:
    """Name after a whole-word "as" (up to a closing bracket); else the
    text before "i.e."/"aka"; else the value."""
    after_as = strip(F.regexp_extract(c, r"(?iUd)(?:\(|\[)?\bas\b\s*([^)\]]+)(?:\)|\])?", 1))
    before = strip(F.regexp_extract(c, r"(?iUd)(.*?)\s+(?:\(|\[)?(?:i\.e\.|aka)", 1))
    return F.coalesce(F.nullif(after_as, F.lit("")), F.nullif(before, F.lit("")), c)


_ROMAN = r"\b(?=[XVI])(IX|IV|V?I{0,3})$"


def standard_name(c: Column) -> Column:
    """Casing rules for personal names, applied in order."""
    # all-upper or all-lower -> capwords per hyphen chunk
    is_upper = (c == F.upper(c)) & (c != F.lower(c))
    is_lower = (c == F.lower(c)) & (c != F.upper(c))
    v = F.when(is_upper | is_lower,
               F.array_join(F.transform(F.split(c, "-"), lambda ch: capwords(ch)), "-")).otherwise(c)
    return v


def _nickname(v: Column) -> Column:
    pat = r"(?sd)^([^'\"]*)['\"](.*)['\"]([^'\"]*)$"
    return F.when(v.rlike(r"(?d)['\"].*['\"]"),
                  F.concat(F.regexp_extract(v, pat, 1), F.lit('"'), capwords(F.regexp_extract(v, pat, 2)),
                           F.lit('"'), F.regexp_extract(v, pat, 3))).otherwise(v)


def _roman(v: Column) -> Column:
    pat = r"(?iUd)^(.*?)" + _ROMAN
    return F.when(v.rlike(r"(?iUd)" + _ROMAN),
                  F.concat(F.regexp_extract(v, pat, 1), F.upper(F.regexp_extract(v, pat, 2)))).otherwise(v)


def _care_of(v: Column) -> Column:
    return F.regexp_replace(v, r"(?iU)\bc/o\b", "c/o")


def _numbered(v: Column) -> Column:
    pat = r"(?Ud)^(.*?)([0-9]+\.)\s*(.+)$"
    return F.when(v.rlike(r"(?Ud)[0-9]+\.\s*.+"),
                  F.concat(F.regexp_extract(v, pat, 1), F.regexp_extract(v, pat, 2), F.lit(" "),
                           capwords(F.regexp_extract(v, pat, 3)))).otherwise(v)


def _initials(v: Column) -> Column:
    chunks = F.filter(F.split(strip(v), r"(?U)\s+"), lambda x: x != "")
    fmt = F.transform(chunks, lambda ch: F.when(
        ch.rlike(r"^\.*\p{L}(?:\.+\p{L})*\.*$"),
        F.regexp_replace(F.upper(F.regexp_replace(ch, r"\.", "")), r"(\p{L})", "$1.")).otherwise(ch))
    return F.array_join(fmt, " ")


NAME_STEPS = [standard_name, _nickname, _roman, _care_of, _numbered, _initials]

# Ordered per-value rules of each field.
RULES = {
    "production_type": [
        strip, replace_ampersand, dedupe_phrase,
        lambda c: upper_except(c, KEEP_CASE_TYPES),
        lambda c: map_terms(c, PRODUCTION_TYPE_TERMS),
    ],
    "Language": [
        strip, capwords, dedupe_phrase, standard_language,
        lambda c: map_terms(c, LANGUAGE_TERMS, upper_key=True),
    ],
    "director": [strip, credited_name, *NAME_STEPS,
                 lambda c: map_terms(c, DIRECTOR_TERMS, upper_key=True)],
}


def rules_for(field: str, as_of_year: int = 2026):
    if field in ("record_date", "release_broadcast_year"):
        return D.date_steps(as_of_year)
    return RULES[field]


def _split(v: Column, delim: str) -> Column:
    """Split by plain text.  A delimiter of one plain character needs no pattern
    compiled for each value."""
    return F.split(F.replace(v, F.lit(delim), F.lit("\x01")), "\x01", -1)


def _unary(step):
    # ``transform`` passes (value, index) to two-parameter functions; rules
    # take one value (extra parameters are keyword options).
    return lambda x: step(x)


def split_multi(field: str, c: Column) -> tuple[Column, Column, Column]:
    """``(values, skip, kept)``: the split values, whether the rules are
    skipped, and the value kept as is when they are."""
    delim = DELIMITERS[field]
    v = strip_chars(strip(F.coalesce(c, F.lit(""))), delim)
    skip = F.lit(False)
    kept = v
    whole = F.lit(False)
    if field == "Language":
        v = F.regexp_replace(F.replace(v, F.lit("N/A"), F.lit("NONE")), "(?iU)" + DELIMITER_PATTERN, delim)
    elif field == "director":
        whole = v.rlike(r"(?i)(n/a|c/o)")
        w = F.regexp_replace(v, r"(?i)i\.\s*e\.\s*,", "i.e.")
        w = F.regexp_replace(w, r"\)([A-Z])", "), $1")
        kinds = F.array_distinct(F.regexp_extract_all(w, F.lit("(?U)" + DELIMITER_PATTERN), 1))
        skip = ~whole & (F.size(kinds) > 1)
        kept = w
        v = F.when(whole, v).otherwise(F.regexp_replace(w, "(?iU)" + DELIMITER_PATTERN, delim))
    else:
        v = F.replace(v, F.lit(";"), F.lit(delim))
    parts = F.transform(F.filter(_split(v, delim), lambda x: x != ""), lambda x: strip(x))
    values = (F.when(v == "", F.array(F.lit("")))
               .when(whole, F.array(v))
               .otherwise(parts))
    return values, skip, kept


def join_multi(values: Column, delim: str) -> Column:
    """Drop empty, keep first occurrences, join."""
    return F.array_join(F.array_distinct(F.filter(values, lambda x: x.isNotNull() & (x != ""))), delim)


def standardise(df: DataFrame, field: str, col: str | None = None, out: str | None = None,
                as_of_year: int = 2026) -> DataFrame:
    """Add ``out`` (default: ``col`` replaced) with the standardised value.

    Helper columns keep each stage a separate projection; Catalyst only
    collapses them where that does not duplicate work.
    """
    col = col or field
    out = out or col
    delim = DELIMITERS[field]
    values, skip, kept = split_multi(field, F.col(f"`{col}`"))
    tmp = df.withColumns({"__vals": values, "__skip": skip, "__kept": kept})
    arr = F.col("__vals")
    for step in rules_for(field, as_of_year):
        arr = F.transform(arr, _unary(step))
    done = F.when(F.col("__skip"), F.col("__kept")).otherwise(join_multi(arr, delim)).alias(out)
    names = [c for c in tmp.columns if c not in ("__vals", "__skip", "__kept")]
    return tmp.select(*[done if c == out else F.col(f"`{c}`") for c in names], *([] if out in names else [done]))


def standardise_value(c, field: str, as_of_year: int = 2026) -> Column:
    """Column form of ``standardise`` (single expression; fine for few fields)."""
    delim = DELIMITERS[field]
    values, skip, kept = split_multi(field, as_col(c))
    for step in rules_for(field, as_of_year):
        values = F.transform(values, _unary(step))
    return F.when(skip, kept).otherwise(join_multi(values, delim))
