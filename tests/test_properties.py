"""Randomised equivalence: Column rules vs the same rules in plain Python
(``str.strip``, ``string.capwords``, ``re``, ``pathlib``) on seeded random
strings, one Spark job per rule family."""

import random
import re
import string
from pathlib import PurePath

from pyspark.sql import functions as F

from kardex.functions import text as T
from kardex.operators.changes import compact_call_number
from kardex.operators.lookups import CODE_PATTERN, extract_codes
from kardex.operators.validation import py_repr

ALPHABET = list("abcXYZ MTRDVFEHA0123456789_-./|&'\"\\\t\r\n") + [" ", " ", "é", "Ü"]


def _strings(n, seed, alphabet=ALPHABET, max_len=14):
    rnd = random.Random(seed)
    return [''.join(rnd.choice(alphabet) for _ in range(rnd.randint(0, max_len))) for _ in range(n)]


def _py_codes(v):
    found = list(dict.fromkeys(re.findall(CODE_PATTERN, v)))
    return "|".join(x for x in found if x != "T01")


def _py_compact(v):
    if len(v) >= 2 and v[-2] == " " and v[-1] in "TMR" and "-" not in v and "and" not in v.lower():
        return v[:-2] + v[-1]
    return v


def _py_dedupe(v):
    m = re.match(r"^(?P<p>.+?)\s+(?P=p)$", v, re.IGNORECASE)
    return m.group("p") if m else v


def test_text_rules_match_python(spark):
    vals = _strings(600, 7)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    rows = df.select("i", T.strip("v").alias("strip"), T.capwords("v").alias("cap"),
                     extract_codes("v").alias("codes"), compact_call_number("v").alias("compact"),
                     T.dedupe_phrase("v").alias("dedupe"), T.replace_ampersand("v").alias("amp"),
                     py_repr(F.col("v")).alias("repr")).orderBy("i").collect()
    bad = []
    for v, r in zip(vals, rows):
        exp = (v.strip(), string.capwords(v), _py_codes(v), _py_compact(v), _py_dedupe(v),
               v if v == "B&W" else v.replace("&", "and"))
        got = (r.strip, r.cap, r.codes, r.compact, r.dedupe, r.amp)
        if exp != got:
            bad.append((v, exp, got))
        if all(c.isprintable() or c in "\t\r\n" for c in v):
            if r.repr != repr(v):
                bad.append((v, repr(v), r.repr))
    assert not bad, bad[:5]


def test_paths_match_pathlib(spark):
    alphabet = list("ab.x/_") + ["json", "JSON", "mov"]
    vals = [p for p in _strings(500, 11, alphabet, 8) if not p.endswith("/") and p not in ("", ".", "..")]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    rows = df.select("i", T.basename("v").alias("name"), T.suffix("v").alias("suffix")).orderBy("i").collect()
    bad = [(v, PurePath(v).name, PurePath(v).suffix, r.name, r.suffix) for v, r in zip(vals, rows)
           if "//" not in v and "/./" not in v and not v.endswith("/.") and not v.startswith("./")
           and (PurePath(v).name, PurePath(v).suffix) != (r.name, r.suffix)]
    assert not bad, bad[:5]
