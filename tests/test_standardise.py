"""Field standardisation against the acceptance pairs of the reference tests
(production type 20, language 15, director 34, date 71)."""

import pytest
from pyspark.sql import functions as F

from kardex.functions.standardise import standardise

# Acceptance pairs (production type, language, director, dates).
PRODUCTION_TYPE = [
    ("Newsreel", "NEWSREELS"),
    ("TITLES, BKGD, OUTS\r ", "TITLES, BKGD, Overlays"),
    ("Made for TV Movies", "MADE FOR TV MOVIE"),
    ("MADE-FOR-TV", "MADE FOR TV MOVIE"),
    ("Silent Films", "SILENT FILM"),
    ("SILENT FILMS", "SILENT FILM"),
    ("SF \rSHORT", "SHORT"),
    ("SF \rNEWSREELS", "NEWSREELS"),
    ("SF \rTITLES, BKGD, OUTS", "TITLES, BKGD, Overlays"),
    ("SF \rUNEDITED FOOTAGE", "UNEDITED FOOTAGE"),
    ("SF \rTRAILERS AND PROMOS", "TRAILERS AND PROMOS"),
    ("SF \rHOME MOVIES", "HOME MOVIES"),
    ("SF \rSHORT\rCOMPILATION", "SHORT\rCOMPILATION"),
    ("SF \rTITLES, BKGD, OUTS\rCARTOONS", "TITLES, BKGD, Overlays\rCARTOONS"),
    ("SF \rUNEDITED FOOTAGE\rTRAILERS AND PROMOS", "UNEDITED FOOTAGE\rTRAILERS AND PROMOS"),
    ("SE \rSHORT", "SHORT"),
    ("FULL SILENT APERTURE 1.33:1\rSHORT\rANIMATION\rSPECIALS", "SHORT\rANIMATION\rSPECIALS"),
    ("B&W\rTRIMS & OUTS", "B&W\rTrims and Outs"),
    ("SHORT SHORT\rTRIMS AND OUTS TRIMS AND OUTS", "SHORT\rTrims and Outs"),
    ("TITLES, BKGD, OVERLAYS", "TITLES, BKGD, Overlays"),
]

LANGUAGE = [
    ("english", "English"),
    ("ENGLISH ", "English"),
    ("Englsh", "English"),
    ("German; English", "German, English"),
    ("French/German", "French, German"),
    ("Italian | Spanish", "Italian, Spanish"),
    ("Spanish and Italian", "Spanish, Italian"),
    ("Chinese & Japanese", "Chinese, Japanese"),
    ("Russian,Italian", "Russian, Italian"),
    ("English; English", "English"),
    ("Portuguese for Brazil", "Portuguese"),
    ("?", "Undetermined"),
    ("Russian Intertitles", "Russian"),
    ("N/A", "No linguistic content"),
    ("N/A | English", "No linguistic content, English"),
]

DIRECTOR = [
    ("OLEG LITVAK, william heick, R.J. CUTLER, MARY ANN DOANE, john a.b.c. doe",
     "Oleg Litvak, William Heick, R.J. Cutler, Mary Ann Doane, John A.B.C. Doe"),
    ("Diego de la Texera, John Van Der Doe", "Diego de la Texera, John Van Der Doe"),
    ("Richard Ray Perez and Lorena Parlee", "Richard Ray Perez, Lorena Parlee"),
    ("Debra Chasnoff\rKim Klausner\rMargaret Lazarus", "Debra Chasnoff, Kim Klausner, Margaret Lazarus"),
    ("Ray Taylor & Lewis D. Collins", "Ray Taylor, Lewis D. Collins"),
    ("Ford Beebe ; John Rawlins", "Ford Beebe, John Rawlins"),
    ("Monogram Productions, Inc. ; a King Brothers production",
     "Monogram Productions, Inc. ; a King Brothers production"),
    ("n/a", "N/A"), ("N/A", "N/A"), ("N/a", "N/A"),
    ("No Director listed", "N/A"),
    ("null, NULL", "Unknown"),
    ("unknown, UNKNOWN, Unknown", "Unknown"),
    ("   ", "Unknown"),
    ("john director-doe", "John Director-Doe"),
    ("Lew Landers (as Louis Friedlander)", "Louis Friedlander"),
    ("JANE DIRECTOR AS STAGE NAME", "Stage Name"),
    ("William Goodrich [i.e. Roscoe Arbuckle]", "William Goodrich"),
    ("Marcus aka Sid Marcus", "Marcus"),
    ("John Doe (aka John D)", "John Doe"),
    ("Jane Doe, William Goodrich i.e. , Roscoe Arbuckle", "Jane Doe, William Goodrich"),
    ("André De Toth (as Andre deToth)", "Andre deToth"),
    ("David MacDonald, Mervyn LeRoy, John O'Brien Doe, LeeRoy Jenkins",
     "David MacDonald, Mervyn LeRoy, John O'Brien Doe, LeeRoy Jenkins"),
    ("Ub Iwerks (uncredited)Shamus Culhane(co-director)",
     "Ub Iwerks (uncredited), Shamus Culhane(co-director)"),
    ("1.Brad Bird\r2. Sam Raimi\r3.Jared Hess\r4. Adam Mckay",
     "1. Brad Bird, 2. Sam Raimi, 3. Jared Hess, 4. Adam Mckay"),
    ("Richard Gerdau ;", "Richard Gerdau"),
    (", Wally Bulloch", "Wally Bulloch"),
    ("John Smith, Tom Jones,", "John Smith, Tom Jones"),
    ("John Smith,, Tom Jones", "John Smith, Tom Jones"),
    ("John Smith,Tom Jones", "John Smith, Tom Jones"),
    ("John Smith, Tom Jones \r\r", "John Smith, Tom Jones"),
    ("Mashuq M Deen, Dawn D Deason", "Mashuq M. Deen, Dawn D. Deason"),
    ("Alex Alferov c/o All Media", "Alex Alferov c/o All Media"),
    ("1.JOHN A.B.C. DOE; jane doe (credited as jane star); LeeRoy Jenkins",
     "1. John A.B.C. Doe, Jane Star, LeeRoy Jenkins"),
]

DATES = [
    ("1999", "1999"), ("1999-01-01", "1999-01-01"), ("1974 ", "1974"), ("n/a", "N/A"),
    ("UUUU", "Unknown"), ("nd", "Unknown"), ("?", "Unknown"), ("uuuu", "Unknown"), ("", "Unknown"),
    ("[1992]", "1992"), ("(1992)", "1992"), ("c 1939", "c1939"), ("COPYRIGHT 2007", "c2007"),
    ("C1988", "c1988"), ("c1978", "c1978"), ("CIRCA 1970", "1970?"), ("ca. 1950", "1950?"),
    ("CA. 2020", "2020?"), ("circa 1925", "1925?"), ("circa 1920-1930", "1920 or 1930"),
    ("January 1956", "1956-01"), ("Feb 1967", "1967-02"), ("Mar 24 1953", "1953-03-24"),
    ("June 28, 1975", "1975-06-28"), ("06/15/1980", "1980-06-15"), ("03-25-1990", "1990-03-25"),
    ("04/1985", "1985-04"), ("01/00/1951", "1951-01"), ("19", "19--?"), ("20-", "20--"),
    ("195-", "195-"), ("196-?", "196-?"), ("1990s", "199-"), ("19??", "19--?"), ("1946?", "1946?"),
    ("195?", "195?"), ("197u", "197-"), ("20UU", "20--?"), ("19uu", "19--?"), ("20XX", "20--?"),
    ("19uu-1971", "19--?-1971"), ("19UU-UUUU", "19--?"), ("193U-UUUU", "193-?"),
    ("1959-UUUU", "1959"), ("1955/1956", "1955/1956"), ("1984/1977/1978", "1984/1977/1978"),
    ("[2011-13]", "2011-2013"), ("1959 - 1963", "1959-1963"), ("1975-76", "1975-1976"),
    ("2015-03-12", "2015-03-12"), ("1939-11-28", "1939-11-28"), ("JUNE 28-29", "JUNE 28-29"),
    ("MAY 9-10, 1980", "MAY 9-10, 1980"), ("APRIL 30 & MAY 1-3, 1980", "APRIL 30 & MAY 1-3, 1980"),
    ("October 17 & 18, 1989", "October 17 & 18, 1989"), ("MAY 7,8 & 9", "MAY 7,8 & 9"),
    ("FALL 1978", "FALL 1978"), ("11-12-1959, 11-19-1959", "11-12-1959, 11-19-1959"),
    ("04-02-1959, 04-09-1959", "04-02-1959, 04-09-1959"), ("C. 1970s", "197-?"),
    ("ca. 1920’s?", "192-?"), ("1960-1970s", "1960-1970"),
    ("10-09-1995\r10-14-2002", "10-09-1995\r10-14-2002"), ("1924 circa", "1924?"),
    ("c 1978.", "c1978"), ("12/10/59", "1959-12-10"), ("12-10-59", "1959-12-10"),
    ("12/10/25", "12/10/25"), ("12-10-25", "12-10-25"), ("08-15-16-1959", "08-15-16-1959"),
    ("4/23-25/1993", "4/23-25/1993"),
]


def _run(spark, field, pairs, as_of_year=2026):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, v string, expected string")
    out = standardise(df, field, "v", "got", as_of_year=as_of_year)
    rows = out.orderBy("i").collect()
    bad = [(r.v, r.expected, r.got) for r in rows if r.got != r.expected]
    assert not bad, "\n".join(repr(b) for b in bad)


def test_production_type(spark):
    _run(spark, "production_type", PRODUCTION_TYPE)


def test_language(spark):
    _run(spark, "Language", LANGUAGE)


def test_director(spark):
    _run(spark, "director", DIRECTOR)


def test_dates(spark):
    _run(spark, "record_date", DATES)


def test_release_year_same_rules(spark):
    _run(spark, "release_broadcast_year", DATES[:20])


def test_more_fixed_date_forms(spark):
    _run(spark, "record_date", [
        ("5 September 1999", "1999-09-05"), ("21st Feb. 1960", "1960-02-21"), ("Sept. 1999", "1999-09"),
        ("September 5th, 1999", "1999-09-05"), ("31 February 1999", "31 February 1999"),
        ("13/25/1999", "13/25/1999"), ("25/12/1999", "1999-12-25"), ("1999; 2000", "1999; 2000"),
    ])


def test_year_expressions_inside_text_and_unknown_digits(spark):
    _run(spark, "record_date", [
        ("199u", "199-"), ("18xx", "18--?"), ("18XX-UUUU", "18--?"), ("195u-uuuu", "195-?"), ("1962-uuuu", "1962"),
        ("ca. 1980s", "198-?"), ("1930's", "193-?"), ("copyright 1999.", "c1999"), ("circa 1950 - 1960", "1950 or 1960"),
        ("1999-12", "1999-12"), ("1999-13", "1999-1913"), ("made circa 1950", "made 1950?"), ("1950 ca.", "1950?."),
    ])


def test_needs_review_flags_free_text(spark):
    from kardex.functions.dates import needs_review
    vals = [("1999", False), ("1999-06", False), ("1999-06-05", False), ("c1999", False), ("199-?", False),
            ("1920 or 1930", False), ("1955/1956", False), ("Unknown", False), ("N/A", False),
            ("FALL 1978", True), ("MAY 7,8 & 9", True), ("", False)]
    df = spark.createDataFrame(vals, "v string, e boolean")
    got = [(r.v, r.g) for r in df.select("v", needs_review(F.col("v")).alias("g")).collect()]
    assert got == [(v, e) for v, e in vals]


def test_year_expressions_among_other_tokens(spark):
    _run(spark, "record_date", [
        ("copyright1999", "c1999"), ("abc1950-51", "abc1950-51"), ("1950-51, 1960-61", "1950-1951, 1960-1961"),
        ("1950 - fall", "1950 - fall"), ("1950-19uu", "1950-19--?"), ("5c 1950", "5c 1950"), ("1959 -1963", "1959-1963"),
        ("19uu – 1971", "19--? – 1971"), ("195u-1960", "195--1960"), ("1975s", "1975s"), ("1970s?", "1970s?"),
        ("1/1/1980 (shown 5/1980)", "1980-01"), ("00/00/1951", "00/00/1951"), ("2/29/1900", "2/29/1900"),
        ("12/00/59", "1959-12"), ("1950, c 1978", "1950, c1978"), ("C. 1970s?", "197-?"),
    ])
