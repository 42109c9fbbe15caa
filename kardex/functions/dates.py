"""Date text normalisation (H19a-e, H20) as Column expressions.

Each step is a function ``Column -> Column`` applied to one value; the
standardiser applies them one ``transform`` at a time over the split values
so no intermediate expression is duplicated.

Only fixed formats are parsed (H20); free-form natural-language dates and
EDTF validation are not built: such values pass through unchanged and
``needs_review`` flags them.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

from kardex.functions._util import let
from kardex.functions.text import PY_WHITESPACE, strip, strip_brackets

# Controlled date terms (case-sensitive keys).
DATE_TERMS = {
    "UUUU": "Unknown", "uuuu": "Unknown", "UUUU-UUUU": "Unknown", "uuuu-uuuu": "Unknown",
    "unknown": "Unknown", "UNKNOWN": "Unknown", "ND": "Unknown", "N": "Unknown",
    "nd": "Unknown", "no date": "Unknown", "": "Unknown", "?": "Unknown", "n/a": "N/A",
}

# Month names and abbreviations accepted at the start of a date.
MONTHS = {
    "january": 1, "february": 2, "march": 3, "april": 4, "may": 5, "june": 6,
    "july": 7, "august": 8, "september": 9, "october": 10, "november": 11, "december": 12,
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "jun": 6, "jul": 7, "aug": 8,
    "sep": 9, "sept": 9, "oct": 10, "nov": 11, "dec": 12,
}
def _map_terms(c: Column, terms: dict) -> Column:
    # ``map[key]`` is null for a missing key (no exception path, unlike
    # ``try_element_at`` under ANSI mode).
    m = F.create_map(*[x for k, v in terms.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(m[c], c)


def map_date_terms(c: Column) -> Column:
    """H12 (dates): exact, case-sensitive controlled terms."""
    return _map_terms(c, DATE_TERMS)


def remove_brackets(c: Column) -> Column:
    """H19a."""
    return strip_brackets(c)

# A value is read as tokens: a number with the letters behind it, a word, white
# space, or one other character.
_TOKEN = r"[0-9]+[A-Za-z]*|[A-Za-z]+|\s+|[^A-Za-z0-9\s]"


def _digits(n: int, tail: str = "") -> list[str]:
    return ["".join(d) + tail for d in product("09", repeat=n)]


def _unknown(n: int) -> list[str]:
    return ["".join(u) for u in product("ux", repeat=n)]


def _kinds() -> dict[str, str]:
    """Kind of each token by its form (lower case, digits but 0 as 9).

    Y year, Z year ending in 0, S such a year with "s", T and U years with one
    and two unknown digits, D and d numbers of two digits and one, o the same
    with an ordinal ending, M month, A "circa", a "ca", c copyright mark,
    x unknown digits alone, s the letter; signs stand for themselves (~: long dash).
    """
    forms = {form: "Z" if form[-1] == "0" else "Y" for form in _digits(4)}
    forms |= {sign: sign for sign in " -/.,?'"} | {"–": "~", "circa": "A", "ca": "a", "c": "c", "copyright": "c", "s": "s"}
    forms |= dict.fromkeys(_digits(2), "D") | dict.fromkeys(_digits(1), "d") | dict.fromkeys(MONTHS, "M")
    forms |= dict.fromkeys(_digits(3, "0s"), "S")
    forms |= {n + u: "T" for n in _digits(3) for u in _unknown(1)} | {n + u: "U" for n in _digits(2) for u in _unknown(2)}
    forms |= {n + end: "o" for k in (1, 2) for n in _digits(k) for end in ("st", "nd", "rd", "th")}
    return forms | {u: "x" for n in range(1, 5) for u in _unknown(n)}


_KINDS = _kinds()
# A year expression in the kinds of its tokens, one letter each: a mark (1), the
# year (2), the ending of a decade (3), a dash (4) and the end of a range (5), a
# mark behind (6), a full stop (7).  It starts where a word or number does.
_EXPRESSION = (r"(?<![AacYZSTUxwsMoDd])([Aac]\.? ?)?([YZSTU])((?<=Z)'s\??|(?<=S)\?)?(?:( ?[-~] ?)([YZSxD]))?"
               r"( ?[Aac](?![YZSTUxwsMoDd]))?(\.)?")
_PARTS = 7


# How an expression is written (Java formats).  1 year without unknown digits, 2
# its first three digits, 3 mark, 4 dash, 5 end of range, 6 century, 7 first
# four characters of the end, 8 mark behind, 9 year as given with what is left of the
# decade ending.
def _heads() -> dict[str, str]:
    """By mark, kind of year, decade ending and mark behind."""
    heads = {}
    for mark, behind in product(("", "A", "a", "c"), ("", "f")):
        whole = "c%1$s" if mark == "c" else "%1$s?" if mark or behind else "%1$s"
        heads |= {mark + kind + behind: whole for kind in "YZ"} | {mark + kind + behind: "%3$s%1$s" for kind in "TU"}
        heads |= {mark + "S" + behind: "%2$s-?" if mark else "%9$s", mark + "Zq" + behind: "%2$s-?"}
    return heads


def _ends() -> dict[str, str]:
    """By kind of year, of the range's end (m: 01 to 12) and of its dash (h
    hyphen, j hyphen among blanks, k long)."""
    ends = {kind + end + dash: "%4$s%5$s" for kind, end, dash in product("YZS", "YZSxDm", "hjk")}
    ends |= {kind + end + dash: "-%5$s" for kind, end, dash in product("YZS", "YZ", "hj")}
    ends |= {kind + end + "h": text for kind in "YZS" for end, text in (("S", "-%7$s"), ("x", ""), ("D", "-%6$s%5$s"))}
    ends |= {kind + end + dash: mark + "%4$s%5$s" for (kind, mark), end, dash in product(
        (("T", "-"), ("U", "--?")), "YZSxDm", "hjk")}
    ends |= {"Txh": "-?", "Uxh": "--?"} | {f"U{end}h": "--?-%5$s" for end in "YZ"}
    return ends | {"T": "-", "U": "--?", "Y": "", "Z": "", "S": ""}


def _table(entries: dict[str, str]) -> Column:
    """A literal map; its ``[key]`` is null for a missing key."""
    return F.str_to_map(F.lit("\n".join(f"{k}\t{v}" for k, v in entries.items())), F.lit("\n"), F.lit("\t"))


def _tokens(v: Column) -> Column:
    """``(text, form)``: the texts of a value's tokens, and their kinds as a
    string of one letter each."""
    kinds = _table(_KINDS)

    def kind(token: Column) -> Column:
        other = F.when(F.btrim(token, F.lit(PY_WHITESPACE)) == "", " ").when(token.rlike("^[A-Za-z0-9]"), "w").otherwise("p")
        return F.coalesce(kinds[F.translate(F.lower(token), "123456789", "999999999")], other)

    return let(F.regexp_extract_all(v, F.lit(_TOKEN), 0), lambda texts: F.struct(
        texts.alias("text"), F.array_join(F.transform(texts, kind), "").alias("form")))


def _written(texts: Column, form: Column) -> Column:
    """One expression, from its tokens' texts and kinds."""
    # A split by one plain character needs no pattern compiled for each value.
    split = F.split(F.regexp_replace(form, _EXPRESSION, ";".join(f"${i}" for i in range(1, _PARTS + 1))), ";", -1)

    def write(p: Column) -> Column:
        ends = [F.lit(0)]
        for i in range(_PARTS):
            ends.append(ends[-1] + F.length(p[i]))
        mark, year, tail, dash, end, behind, stop = (
            F.array_join(F.slice(texts, a + 1, F.length(p[i])), "") for i, a in enumerate(ends[:-1]))
        return let(F.struct(
            F.substring(p[0], 1, 1).alias("mark_kind"), p[1].alias("kind"), F.rtrim(year, F.lit("uUxXsS")).alias("stem"),
            F.concat(year, tail).alias("year"), mark.alias("mark"), dash.alias("dash"), end.alias("end"), stop.alias("stop"),
            F.when(p[2] == "", "").otherwise("q").alias("decade"), behind.alias("behind"), p[4].alias("end_kind")), put)

    def put(s: Column) -> Column:
        end = F.when(s["end"] == "", "").otherwise(F.concat(
            F.when(s["end"].between("01", "12") & (s["end_kind"] == "D"), "m").otherwise(s["end_kind"]),
            F.when(s["dash"] == "-", "h").when(s["dash"].contains("-"), "j").otherwise("k")))
        decade = F.when(s["kind"] == "Z", s["decade"]).otherwise("")
        head = F.concat(s["mark_kind"], s["kind"], decade, F.when(s["behind"] == "", "").otherwise("f"))
        choice = (s["mark_kind"] == "A") & s["kind"].isin("Y", "Z") & s["end_kind"].isin("Y", "Z")
        pattern = F.when(choice, "%1$s or %5$s").otherwise(F.concat(
            _table(_heads())[head], _table(_ends())[F.concat(s["kind"], end)],
            F.when(s["kind"].isin("T", "U"), "%8$s").otherwise("")))
        stop = F.when(s["mark_kind"] == "c", "").otherwise(s["stop"])
        return F.concat(F.call_function(
            "format_string", pattern, s["stem"], F.substring(s["stem"], 1, 3), s["mark"], s["dash"], s["end"],
            F.substring(s["stem"], 1, 2), F.substring(s["end"], 1, 4), s["behind"], s["year"]), stop)

    return let(split, write)


def year_expressions(c: Column) -> Column:
    """H19b, H19d, H19e: a value is read as tokens once; each year expression
    among them is written in the controlled form, other text stays."""
    def rewrite(v: Column) -> Column:
        return let(F.struct(v["text"].alias("text"), F.split(F.regexp_replace(v["form"], _EXPRESSION, ";"), ";", -1).alias("between"),
                            F.regexp_extract_all(v["form"], F.lit(_EXPRESSION), 0).alias("found")), join)

    def join(v: Column) -> Column:
        part = lambda start, size: F.slice(v["text"], start, size)

        def add(s: Column, piece: Column) -> Column:
            start = s["at"] + F.length(piece["between"])
            size = F.length(piece["found"])
            return F.struct((start + size).alias("at"), F.concat(
                s["out"], F.array_join(part(s["at"], F.length(piece["between"])), ""),
                _written(part(start, size), piece["found"])).alias("out"))

        pieces = F.zip_with(v["found"], F.slice(v["between"], F.lit(1), F.size(v["found"])), lambda f, b: F.struct(
            f.alias("found"), b.alias("between")))
        return F.aggregate(pieces, F.struct(F.lit(1).alias("at"), F.lit("").alias("out")), add, lambda s: F.concat(
            s["out"], F.array_join(part(s["at"], F.size(v["text"])), "")))

    plain = F.translate(c, "’‘", "''")
    # A value of digits and other signs alone holds nothing to be written anew.
    return strip(F.when(plain.rlike("[0-9]") & plain.rlike("[A-Za-z–-]"), let(_tokens(plain), rewrite)).otherwise(plain))


# Endings of a partial year, by its form (9: any digit).
PARTIAL_FORMS = {"99": "--?", "99-": "--", "99??": "--?", "999": "-?", "9990s": "-"}


def partial_years(c: Column) -> Column:
    """A whole value of two or three known digits, or a decade."""
    form = F.translate(c, "0123456789", "9999999999")
    form = F.when(c.endswith("0s") & (form == "9999s"), "9990s").otherwise(form)
    ending = _table(PARTIAL_FORMS)[form]
    known = F.when(form.startswith("999"), F.substring(c, 1, 3)).otherwise(F.substring(c, 1, 2))
    return F.coalesce(F.concat(known, ending), c)


def _iso(y: Column, m: Column, d: Column | None = None) -> Column:
    """``YYYY-MM[-DD]`` text; null when the date does not exist."""
    if d is None:
        ok = m.between(1, 12)
        return F.when(ok, F.format_string("%04d-%02d", y, m))
    # Out-of-range parts never reach the parser (its failure path is costly);
    # only days 29-31 need a calendar check.
    ok = m.between(1, 12) & d.between(1, 31) & y.between(1, 9999)
    text = F.format_string("%04d-%02d-%02d", y, m, d)
    checked = F.date_format(F.try_to_date(text, "yyyy-MM-dd"), "yyyy-MM-dd")
    return F.when(ok, F.when(d <= 28, text).otherwise(checked))


def _number(c: Column) -> Column:
    """A token's leading digits."""
    return F.regexp_extract(c, "^[0-9]{1,4}", 0).cast("int")


# Orders of a whole value's day, month name and year; blanks, full
# stops, commas and ordinal endings do not count.
MONTH_NAME_ORDERS = ["MDY", "DMY", "MY"]


def iso_date(c: Column, as_of_year: int) -> Column:
    """Fixed-format dates to ISO; anything else is returned unchanged.

    The kinds of a value's tokens, one letter each, are its form.  A whole value
    with a month name is looked up by its form.  Numeric dates are found by
    their place in the form, which is their place among the tokens: month, day
    and two-digit year (above ``as_of_year % 100``: of the last century), month,
    day and year, month and year; day 0 is none.  Lists and ranges of days, that is
    four numbers and more between separators, stay.
    """
    cutoff = as_of_year % 100
    months = _table({k: str(v) for k, v in MONTHS.items()})

    def read(v: Column) -> Column:
        return let(F.struct(F.translate(v["form"], "Zdo-", "YDD/").alias("form"), v["text"].alias("text")), from_form)

    def from_form(v: Column) -> Column:
        form, text = v["form"], v["text"]

        def at(find: str, place: int = 0) -> Column:
            return F.get(text, F.instr(form, find) - 1 + place)

        named = F.translate(form, " .,", "").isin(MONTH_NAME_ORDERS)
        month = months[F.lower(at("M"))].cast("int")
        by_name = F.when(named, F.when(form.contains("D"), _iso(_number(at("Y")), month, _number(at("D"))))
                         .otherwise(_iso(_number(at("Y")), month)))
        m, d, y = (_number(at("D/D/Y", i)) for i in (0, 2, 4))
        whole = F.when(form == "D/D/Y", F.coalesce(_iso(y, m, d), _iso(y, d, m)))
        full = F.when(form.contains("D/D/Y"), F.when((d == 0) & m.between(1, 12), _iso(y, m)).otherwise(whole))
        month_year = F.when(form.contains("D/Y"), _iso(_number(at("D/Y", 2)), _number(at("D/Y"))))
        return F.when(~short(v), F.coalesce(by_name, full, month_year)).otherwise(short_year(v))

    def short(v: Column) -> Column:
        last = F.get(v["text"], F.instr(v["form"], "D/D/D") + 3)
        return v["form"].contains("D/D/D") & (F.length(last) == 2)

    def short_year(v: Column) -> Column:
        m, d, y = (_number(F.get(v["text"], F.instr(v["form"], "D/D/D") - 1 + i)) for i in (0, 2, 4))
        return F.when(y > cutoff, F.when((d == 0) & m.between(1, 12), _iso(y + 1900, m)).otherwise(_iso(y + 1900, m, d)))

    def parts(v: Column) -> Column:
        return F.size(F.filter(F.split(F.translate(v, "-", "/"), "/"), lambda x: x.rlike("^[0-9]+$")))

    def date(s: Column) -> Column:
        # A date has a separator or a letter; a list has four parts and more.
        may = s.rlike("[0-9][/-][0-9]|[A-Za-z]{3}") & s.rlike("[0-9]") & (parts(s) < 4)
        return F.when(may, F.coalesce(let(_tokens(s), read), s)).otherwise(s)

    return let(strip(F.coalesce(c, F.lit(""))), date)


def date_steps(as_of_year: int):
    """Ordered per-value rules of the two date fields."""
    return [strip, map_date_terms, remove_brackets, partial_years, year_expressions,
            lambda c: iso_date(c, as_of_year)]


def needs_review(c: Column) -> Column:
    """True for a non-empty standardised date that is not in a known form."""
    known = (r"^(Unknown|N/A|[0-9]{4}(-[0-9]{2}(-[0-9]{2})?)?\??|[0-9]{4}-[0-9]{4}|c[0-9]{4}\??|"
             r"[0-9]{2,3}-+\??(-[0-9]{4})?|[0-9]{4} or [0-9]{4}|[0-9]{4}(/[0-9]{4})+)$")
    return (F.coalesce(c, F.lit("")) != "") & ~c.rlike(known)
