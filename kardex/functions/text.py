"""Scalar text rules as Column expressions (JVM-side, codegen friendly).

Python's ``str.strip``/``split`` treat every Unicode whitespace character
(NBSP, CR, ...) as whitespace while Spark's ``trim`` strips only spaces, so
the helpers here use ``(?U)`` regexes instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kardex.functions._util import as_col

# Python's whitespace set (``str.isspace``), generated from its rule.
PY_WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
NBSP = "\u00a0"


def strip(c) -> Column:
    """H1: Python ``str.strip()``: remove leading/trailing Unicode whitespace
    (``btrim`` with the whitespace set: no regex)."""
    return F.btrim(as_col(c), F.lit(PY_WHITESPACE))


def strip_chars(c, chars: str) -> Column:
    """Python ``str.strip(chars)``: remove any of ``chars`` at both ends."""
    return F.btrim(as_col(c), F.lit(chars))


def is_blank(c) -> Column:
    """H2: null, empty or whitespace only."""
    return F.coalesce(strip(c), F.lit("")) == ""


def blank_to_null(c) -> Column:
    """Strip; empty becomes null."""
    return F.nullif(strip(c), F.lit(""))


def holdings_key(c) -> Column:
    """H3: holdings call number key: remove ASCII spaces, upper case."""
    return F.upper(F.replace(as_col(c), F.lit(" "), F.lit("")))


def inventory_key(c) -> Column:
    """H3: inventory number key: remove NBSP, upper case."""
    return F.upper(F.replace(as_col(c), F.lit(NBSP), F.lit("")))


def collapse_ws(c) -> Column:
    """Python ``" ".join(s.split())``: strip and collapse whitespace runs."""
    return F.regexp_replace(strip(c), r"(?U)\s+", " ")


def capwords(c) -> Column:
    """``string.capwords``: split on whitespace, capitalise, join by space.

    ``initcap`` upper-cases the first letter of each space-separated word and
    lower-cases the rest, which is ``str.capitalize`` once runs of whitespace
    are collapsed to one space.
    """
    return F.initcap(collapse_ws(c))


def replace_ampersand(c, keep=("B&W",)) -> Column:
    """H8: ``&`` -> ``and`` unless the whole value is one of ``keep``."""
    c = as_col(c)
    return F.when(c.isin(*keep), c).otherwise(F.replace(c, F.lit("&"), F.lit("and")))


def dedupe_phrase(c) -> Column:
    """H9: ``phrase <ws> phrase`` (case-insensitive) -> first ``phrase``."""
    return F.regexp_replace(as_col(c), r"(?iUd)^(.+?)\s+\1$", "$1")


def upper_except(c, keep) -> Column:
    """Upper case unless the value is one of ``keep``."""
    c = as_col(c)
    return F.when(c.isin(*keep), c).otherwise(F.upper(c))


def strip_brackets(c) -> Column:
    """Drop ``[]()`` and strip; null/empty -> ``""``."""
    return strip(F.translate(F.coalesce(as_col(c), F.lit("")), "[]()", ""))


def basename(c) -> Column:
    """Last component of a ``/``-separated path."""
    return F.regexp_extract(as_col(c), r"([^/]*)$", 1)


def suffix(c) -> Column:
    """``PurePath.suffix``: the last ``.ext`` of the name, empty for
    dot-files (``.bashrc``) and for names ending in a dot."""
    return F.regexp_extract(basename(c), r"(?s)^.+(\.[^.]+)$", 1)


def title_join(*cols) -> Column:
    """``". ".join`` of the non-empty parts (null counts as empty)."""
    return F.concat_ws(". ", *[F.nullif(as_col(x), F.lit("")) for x in cols])


def normalized_levenshtein(a, b) -> Column:
    """Levenshtein distance divided by the longer length (0 when both empty)."""
    a, b = as_col(a), as_col(b)
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(0.0)).otherwise(
        F.levenshtein(a, b).cast("double") / longest)


def title_score(a, b) -> Column:
    """1 - normalised Levenshtein; 0 when either side is empty."""
    a, b = F.coalesce(as_col(a), F.lit("")), F.coalesce(as_col(b), F.lit(""))
    return F.when((a == "") | (b == ""), F.lit(0.0)).otherwise(
        F.lit(1.0) - normalized_levenshtein(a, b))


def nearest_term(c, terms) -> Column:
    """O2: argmin of normalised Levenshtein over a controlled list.

    Ties go to the earlier list entry (the index is the second struct field).
    Returns a struct ``(dist, idx, term)``.
    """
    c = as_col(c)
    arr = F.array(*[F.lit(t) for t in terms])
    scored = F.transform(
        arr, lambda t, i: F.struct(normalized_levenshtein(c, t).alias("dist"),
                                   i.alias("idx"), t.alias("term")))
    return F.array_min(scored)
