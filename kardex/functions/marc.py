"""MARC bibliographic record functions (H23-H30, H34-H40, H43, H45, H46, P6,
P12, P13) as Column expressions over the MARCXML struct shape read by the
built-in XML source (``rowTag="record"``):

    leader STRING,
    controlfield ARRAY<STRUCT<_tag STRING, _VALUE STRING>>,
    datafield ARRAY<STRUCT<_tag STRING, _ind1 STRING, _ind2 STRING,
                           subfield ARRAY<STRUCT<_code STRING, _VALUE STRING>>>>

Everything is higher-order array functions (``filter``/``transform``/
``exists``), evaluated per record; no UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kardex.functions._util import let, lit_array
from kardex.functions.text import strip

CF, DF = "controlfield", "datafield"


def _cf(rec: str | None = None) -> Column:
    return F.col(f"{rec}.{CF}" if rec else CF)


def _df(rec: str | None = None) -> Column:
    return F.col(f"{rec}.{DF}" if rec else DF)


def fields(tag: str | list, rec: str | None = None) -> Column:
    """All data fields with ``tag`` (or any of a list of tags), in order."""
    tags = [tag] if isinstance(tag, str) else list(tag)
    return F.filter(F.coalesce(_df(rec), F.array()), lambda f: f["_tag"].isin(*tags))


def subfield_values(field: Column, code: str) -> Column:
    """Values of subfield ``code`` of one data field, in order."""
    return F.transform(F.filter(F.coalesce(field["subfield"], F.array()), lambda s: s["_code"] == code),
                       lambda s: s["_VALUE"])


def subfields(tag: str, code: str, rec: str | None = None) -> Column:
    """Every ``tag $code`` value over repeated fields, in order."""
    return F.flatten(F.transform(fields(tag, rec), lambda f: subfield_values(f, code)))


def first_subfield(tag: str, code: str, rec: str | None = None) -> Column:
    """The first value as a 0/1-element array."""
    return F.slice(subfields(tag, code, rec), 1, 1)


def control(tag: str, rec: str | None = None) -> Column:
    """Text of the first control field ``tag`` (null when absent)."""
    return F.get(F.filter(F.coalesce(_cf(rec), F.array()), lambda c: c["_tag"] == tag), 0)["_VALUE"]


def has_control(tag: str, rec: str | None = None) -> Column:
    return F.exists(F.coalesce(_cf(rec), F.array()), lambda c: c["_tag"] == tag)


def bib_id(rec: str | None = None) -> Column:
    return control("001", rec)


def language(rec: str | None = None) -> Column:
    """Language code 008/35-37; ``###`` when there is no 008."""
    return F.when(has_control("008", rec), F.substring(F.coalesce(control("008", rec), F.lit("")), 36, 3)) \
        .otherwise(F.lit("###"))


def pick_fields(tags, rec: str | None = None) -> Column:
    """The control and data fields whose tag is listed, as a struct."""
    return F.struct(F.filter(F.coalesce(_cf(rec), F.array()), lambda c: c["_tag"].isin(*tags)).alias(CF),
                    fields(list(tags), rec).alias(DF))


# ---------------------------------------------------------------------------
# Data quality checks
# ---------------------------------------------------------------------------

def no_008(rec: str | None = None) -> Column:
    """H26: "Yes" when there is no 008."""
    return F.when(has_control("008", rec), F.lit("")).otherwise(F.lit("Yes"))


def invalid_language(valid: Column, rec: str | None = None) -> Column:
    """H27: "" (no 008 or valid), "BLANK", "TOO SHORT" or the unknown code.

    ``valid`` is a boolean Column telling whether ``language_code`` (the
    008/35-37 text) is in the code table (J12 join)."""
    def check(data):
        code = F.substring(data, 36, 3)
        return (F.when(data.isNull(), F.lit(""))
                 .when(F.length(data) < 38, F.when(strip(data) == "", F.lit("BLANK")).otherwise(F.lit("TOO SHORT")))
                 .when(code == "   ", F.lit("BLANK"))
                 .when(~F.coalesce(valid, F.lit(False)), code)
                 .otherwise(F.lit("")))
    return let(F.when(has_control("008", rec), F.coalesce(control("008", rec), F.lit(""))), check)


def language_code(rec: str | None = None) -> Column:
    """008/35-37 (null without 008), the key for the code-table join."""
    return F.when(has_control("008", rec), F.substring(F.coalesce(control("008", rec), F.lit("")), 36, 3))


def no_26x_date(rec: str | None = None) -> Column:
    """H28: "Yes" when no 260$c or 264$c has a non-blank value."""
    dates = F.concat(subfields("260", "c", rec), subfields("264", "c", rec))
    return F.when(F.exists(dates, lambda d: strip(d) != ""), F.lit("")).otherwise(F.lit("Yes"))


# Statement-of-responsibility phrases.
ATTRIBUTION_PHRASES = ["directed by", "director", "directors", "a film by", "supervised by"]


def lacks_attribution(rec: str | None = None) -> Column:
    """H29: "Yes" unless the first 245$c contains an attribution phrase."""
    f245 = F.get(fields("245", rec), 0)
    c = F.lower(F.get(subfield_values(f245, "c"), 0))

    def check(c):
        hit = F.exists(lit_array(ATTRIBUTION_PHRASES), lambda p: F.coalesce(F.contains(c, p), F.lit(False)))
        return F.when(c.isNull(), F.lit("Yes")).when(hit, F.lit("")).otherwise(F.lit("Yes"))
    return let(c, check)


# Trailing punctuation trimmed from title parts (our definition).
TRAILING_PUNCT = r"(?U)[\s.,:;/=]+$"


def _trim_title(c: Column) -> Column:
    return F.regexp_replace(strip(c), TRAILING_PUNCT, "")


def bib_title(rec: str | None = None) -> Column:
    """Struct ``(title, check_ind2)``.

    First 245 $a/$b/$n/$p, each trimmed of trailing punctuation; a leading
    English article moves to the end using indicator 2 (non-filing
    characters); ``check_ind2`` when article and indicator disagree."""
    f245 = F.get(fields("245", rec), 0)
    part = lambda code: F.coalesce(_trim_title(F.get(subfield_values(f245, code), 0)), F.lit(""))
    ind2 = f245["_ind2"]
    nfc = F.coalesce(F.when(ind2.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.trim(ind2).cast("int")), F.lit(0))
    parts = F.struct(f245.isNull().alias("none"), part("a").alias("a"), part("b").alias("b"),
                     part("n").alias("n"), part("p").alias("p"), nfc.alias("nfc"))
    return let(parts, _title_from_parts)


def _title_from_parts(r: Column) -> Column:
    a, nfc = r["a"], r["nfc"]
    low = F.lower(a)
    art_len = (F.when(low.startswith("a "), 2).when(low.startswith("an "), 3)
                .when(low.startswith("the "), 4).otherwise(0))
    # How many leading characters go to the end: the article's, else as many as
    # the indicator says; none if the indicator covers the whole title.
    offset = (F.when((art_len > 0) & (nfc != 0) & (F.length(a) <= nfc), 0)
               .when(art_len > 0, art_len).otherwise(nfc))
    moved = F.concat(strip(F.substr(a, offset + 1)), F.lit(", "), strip(F.substr(a, F.lit(1), offset)))
    main = F.when(offset != 0, moved).otherwise(a)
    # An article that the indicator does not count is worth a look.
    flag = (art_len > 0) & (offset != 0) & (nfc != art_len)
    title = F.concat_ws(". ", *[F.nullif(x, F.lit("")) for x in (main, r["b"], r["n"], r["p"])])
    return F.when(r["none"], F.struct(F.lit("").alias("title"), F.lit(False).alias("check_ind2"))) \
        .otherwise(F.struct(title.alias("title"), flag.alias("check_ind2")))


# ---------------------------------------------------------------------------
# Features and directors
# ---------------------------------------------------------------------------

# Words marking a director segment, and phrases excluding one.
DIRECTOR_WANTED = ["directed", "director", "a film by"]
DIRECTOR_UNWANTED = [
    "director of interior photography", "exteriors directed by", "revue director",
    "staging director", "technical director", "TV director", "television director",
]


def director_segments(values: Column) -> Column:
    """Join with space, split on ``;``, strip; keep segments with a
    wanted word and none of the unwanted phrases (case-sensitive)."""
    segs = F.transform(F.split(F.array_join(values, " "), ";"), lambda s: strip(s))
    return F.filter(segs, lambda s: ~F.exists(lit_array(DIRECTOR_UNWANTED), lambda u: F.contains(s, u))
                    & F.exists(lit_array(DIRECTOR_WANTED), lambda w: F.contains(s, w)))


def person_names(mentions: Column, within: Column | None = None) -> Column:
    """Distinct PERSON texts of a mentions array<struct<text,label>>,
    sorted; with ``within`` (segments), only mentions found in a segment."""
    people = F.filter(mentions, lambda m: m["label"] == "PERSON")
    if within is not None:
        people = F.filter(people, lambda m: F.exists(within, lambda s: F.contains(s, m["text"])))
    return F.array_sort(F.array_distinct(F.transform(people, lambda m: m["text"])))


def fix_name_suffix(names: Column, suffix: str = "Jr.") -> Column:
    """Exactly two names, one of them "Jr." -> ``["<other>, Jr."]``."""
    other = F.get(F.filter(names, lambda n: n != suffix), 0)
    return F.when((F.size(names) == 2) & F.array_contains(names, suffix) & other.isNotNull(),
                  F.array(F.concat(other, F.lit(", " + suffix)))).otherwise(names)


def director_names(values: Column, mentions: Column) -> Column:
    """H46 for one subfield list: no director segment -> []; else the PERSON
    mentions inside the segments (H45) with the Jr. fix (H36)."""
    segs = director_segments(values)
    return F.when(F.size(segs) == 0, F.array().cast("array<string>")) \
        .otherwise(fix_name_suffix(person_names(mentions, segs)))


def bib_features(mentions: str | None = None, rec: str | None = None) -> list[Column]:
    """P13 (+H46 when a mentions column is given): one column per feature."""
    cols = [
        bib_id(rec).alias("bib_id"), language(rec).alias("language"),
        first_subfield("245", "a", rec).alias("f245a"), first_subfield("245", "c", rec).alias("f245c"),
        subfields("245", "n", rec).alias("f245n"), subfields("245", "p", rec).alias("f245p"),
        subfields("246", "a", rec).alias("f246a"), subfields("250", "a", rec).alias("f250a"),
        subfields("505", "a", rec).alias("f505a"), subfields("505", "r", rec).alias("f505r"),
    ]
    if mentions is not None:
        m = F.col(mentions)
        cols.append(F.struct(director_names(first_subfield("245", "c", rec), m).alias("f245c"),
                             director_names(subfields("245", "p", rec), m).alias("f245p")).alias("directors"))
    return cols


# The decision list 6.1-6.8.
def _criteria_flags(c: Column, p: Column, a: Column, pp: Column, n: Column, ed: Column, lang: Column):
    has = lambda x: F.size(x) > 0
    eng = lang == "eng"
    return [
        ("6.1", (c == 1) & has(a) & ~has(pp) & ~has(ed) & eng),
        ("6.2", (c == 1) & has(a) & (has(ed) | ~eng)),
        ("6.3", (c == 1) & ((has(a) & has(pp)) | (has(a) & has(n)))),
        ("6.4", (c > 1) & has(a) & ~has(ed) & eng),
        ("6.5", (c > 1) & has(a) & (has(ed) | ~eng)),
        ("6.6", (c > 1) & ((has(a) & has(pp)) | (has(a) & has(n)))),
        ("6.7", c == 0),
        ("6.8", p > 0),
    ]


def _flags_from(features: str | None = None):
    pre = f"{features}." if features else ""
    g = lambda n: F.col(pre + n)
    return _criteria_flags(F.size(g("directors.f245c")), F.size(g("directors.f245p")), g("f245a"),
                           g("f245p"), g("f245n"), g("f250a"), g("language"))


def first_criterion(features: str | None = None) -> Column:
    """The first criterion of the 6.1-6.9 decision list that holds."""
    out = None
    for name, cond in _flags_from(features):
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out.otherwise(F.lit("6.9"))


def all_criteria(features: str | None = None) -> Column:
    """Every criterion that holds; ["6.9"] when none does."""
    hits = F.filter(F.array(*[F.when(cond, F.lit(name)) for name, cond in _flags_from(features)]),
                    lambda x: x.isNotNull())
    return F.when(F.size(hits) == 0, F.array(F.lit("6.9"))).otherwise(hits)


# ---------------------------------------------------------------------------
# Monograph classification
# ---------------------------------------------------------------------------

# Production-type phrases marking a non-monograph.
NON_MONOGRAPH_TYPES = ["television series", "compilation", "mini-series", "news", "newsreel", "serials"]
# Monograph production types and their standard form names.
MONOGRAPH_TYPES = {
    "ADVERTISING": "Advertisements", "ANIMATION": "Animation", "ANTHOLOGIES": "Anthology films",
    "CARTOONS": "Animation", "COMMERCIALS": "Television commercials",
    "DEMO REELS AND TAPES": "Demo reels and tapes", "DOCUMENTARY": "Documentary",
    "EDUCATIONAL": "Educational", "FEATURE FILM": "Feature films", "HOME MOVIES": "Home movies",
    "MADE FOR TV MOVIE": "Made for TV movies", "MUSIC VIDEO": "Music shorts", "SHORT": "Shorts",
    "SPECIALS": "Specials", "STUDENT": "Student films",
    "TITLES, BKGD, Outs": "Titles, background, overlays",
    "TRAILERS AND PROMOS": "Trailers and promos", "Trims and Outs": "Trims and outs",
    "UNEDITED FOOTAGE": "Unedited footage", "VARIETY": "Variety",
}
# genre/form terms (655 $a) of non-monographs.
NON_MONOGRAPH_FORMS = [
    "Compilations", "Mini-series", "News", "Newsreels", "Serials", "Television mini-series",
    "Television news programs", "Film serials", "Animated television programs",
]
# Monograph genre/form terms, local-only terms, and their mapping.
MONOGRAPH_FORMS = [
    "Animation", "Cartoons", "Documentaries and factual films and video", "Features",
    "Feature films", "Made for TV movies", "Shorts", "Specials", "Animated films", "Music shorts",
    "Commercials", "Television commercials", "Theater advertising",
]
LOCAL_MONOGRAPH_FORMS = ["Student films and video"]
FORM_NAMES = {
    "Theater advertising": "Advertisements", "Animated films": "Animation", "Cartoons": "Animation",
    "Commercials": "Television commercials",
    "Documentaries and factual films and video": "Documentary", "Features": "Feature films",
    "Student films and video": "Student films",
}


def _map(c: Column, mapping: dict) -> Column:
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(m[c], c)


def non_monograph_type(c: Column) -> Column:
    """A non-monograph phrase occurs in the lower-cased types."""
    low = F.lower(F.coalesce(c, F.lit("")))
    return F.exists(lit_array(NON_MONOGRAPH_TYPES), lambda p: F.contains(low, p))


def inventory_forms(c: Column) -> Column:
    """Monograph type phrases found (case-insensitive), in list order,
    mapped to standard form names."""
    low = F.lower(F.coalesce(c, F.lit("")))
    found = F.filter(lit_array(list(MONOGRAPH_TYPES)), lambda t: F.contains(low, F.lower(t)))
    return F.transform(found, lambda t: _map(t, MONOGRAPH_TYPES))


def non_monograph_bib(rec: str | None = None) -> Column:
    """245 with $p or $n; any 250 or 505; a non-monograph 655$a; or
    both "Anthologies" and "Short films"."""
    # A field's ``["p"]`` is its first $p; only a non-empty first value counts.
    title_parts = F.exists(fields("245", rec), lambda f: (F.coalesce(F.get(subfield_values(f, "p"), 0), F.lit("")) != "")
                           | (F.coalesce(F.get(subfield_values(f, "n"), 0), F.lit("")) != ""))
    other = F.size(fields(["250", "505"], rec)) > 0
    forms = subfields("655", "a", rec)
    form_hit = F.arrays_overlap(forms, lit_array(NON_MONOGRAPH_FORMS))
    pair = F.array_contains(forms, "Anthologies") & F.array_contains(forms, "Short films")
    return title_parts | other | F.coalesce(form_hit, F.lit(False)) | pair


def bib_forms(rec: str | None = None) -> Column:
    """655 forms of monographs (first $a without trailing dots; with
    ``$2 = local`` only the local list counts), mapped to standard names."""
    def pick(f):
        a = F.get(subfield_values(f, "a"), 0)
        bare = F.regexp_replace(a, r"\.+$", "")
        is_local = subfield_values(f, "2") == F.array(F.lit("local"))
        ok = F.when(is_local, F.array_contains(lit_array(LOCAL_MONOGRAPH_FORMS), bare)) \
            .otherwise(F.array_contains(lit_array(MONOGRAPH_FORMS), bare))
        return F.when(a.isNotNull() & ok, bare)
    picked = F.filter(F.transform(fields("655", rec), pick), lambda x: x.isNotNull())
    return F.transform(picked, lambda v: _map(v, FORM_NAMES))


def is_monograph(production_type: Column, rec: str | None = None) -> Column:
    """Inventory type present -> not H37; absent -> not H39."""
    has_type = F.coalesce(production_type, F.lit("")) != ""
    return F.when(has_type, ~non_monograph_type(production_type)).otherwise(~non_monograph_bib(rec))


def compare_forms(a: Column, b: Column) -> Column:
    """``(common, only_a, only_b)`` as sorted distinct arrays."""
    a, b = F.array_distinct(a), F.array_distinct(b)
    return F.struct(F.array_sort(F.array_intersect(a, b)).alias("common"),
                    F.array_sort(F.array_except(a, b)).alias("unique_bib"),
                    F.array_sort(F.array_except(b, a)).alias("unique_inventory"))


# ---------------------------------------------------------------------------
# Output document
# ---------------------------------------------------------------------------

def _field_values(tags, rec=None) -> Column:
    return F.transform(fields(tags, rec), lambda f: F.array_join(
        F.transform(F.coalesce(f["subfield"], F.array()), lambda s: s["_VALUE"]), " "))


def _nonempty(c: Column) -> Column:
    return F.when(F.size(c) > 0, c)


def mams_projection(features: str = "features", rec: str | None = None) -> Column:
    """Flat output document; empty lists become null so ``to_json``
    drops them (P9)."""
    ft = lambda n: F.col(f"{features}.{n}")
    directors = F.concat(ft("directors.f245c"), ft("directors.f245p"))
    return F.struct(
        ft("bib_id").alias("bib_id"),
        _nonempty(ft("f245a")).alias("title"),
        _nonempty(subfields("246", "a", rec)).alias("alternative_titles"),
        _nonempty(subfields("245", "p", rec)).alias("episode_titles"),
        _nonempty(ft("f245a")).alias("series_title"),
        _nonempty(_field_values(["490", "830"], rec)).alias("subseries_titles"),
        _nonempty(subfields("245", "n", rec)).alias("episode_numbers_245"),
        _nonempty(subfields("246", "n", rec)).alias("episode_numbers_246"),
        F.nullif(ft("language"), F.lit("")).alias("language"),
        _nonempty(_field_values("041", rec)).alias("language_other"),
        _nonempty(directors).alias("directors"),
    )


# ---------------------------------------------------------------------------
# Span annotations
# ---------------------------------------------------------------------------

def span_annotations(text: Column, names: Column, label: str = "PERSON") -> Column:
    """``(start, end, label)`` per name; a name not found has start -1."""
    return F.transform(names, lambda n: F.struct(
        (F.position(n, text) - 1).alias("start"),
        (F.position(n, text) - 1 + F.length(n)).alias("end"),
        F.lit(label).alias("label")))
