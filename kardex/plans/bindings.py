"""Archive tables derived from the driver's TPC-H-like test tables.

The reconciliation operators need holdings, inventory, digital and sheet
records.  They are *derived* from the given parquet tables with plain SQL
expressions, so the Spark plan and the DuckDB oracle start from the same bytes
and their size grows with the scale factor:

* keys come from an integer ``k`` and a period ``p``:
  ``CASE WHEN k % p = 0 THEN k ELSE k - k % p + 1 END`` gives singletons at
  multiples of ``p`` and groups of ``p - 1`` elsewhere;
* the prefix of an inventory number is a function of the number itself, so
  equal numbers agree across sources;
* dirty text is built from a clean value (a date, a name) and the oracle
  checks against the clean value.

Each binding is a list of ``expr AS name`` strings in the SQL subset shared by
Spark SQL and DuckDB (CASE, %, ||, CAST AS STRING, chr, lower, upper).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def _grouped(k: str, p: int) -> str:
    return f"(CASE WHEN {k} % {p} = 0 THEN {k} ELSE {k} - {k} % {p} + 1 END)"


def _prefix(n: str) -> str:
    # Fixed prefix rule: a number always carries the same prefix in every source.
    return (f"(CASE {n} % 5 WHEN 0 THEN 'DVD' WHEN 1 THEN 'VA' WHEN 2 THEN 'M' "
            f"WHEN 3 THEN 'XFE' ELSE 'HFA' END)")


def _s(x: str) -> str:
    return f"CAST({x} AS STRING)"


_HK = _grouped("o_orderkey", 3)
_IK = _grouped("o_orderkey", 4)
_DK = _grouped("event_id", 5)

# name -> (source table, [select expressions])
BINDINGS: dict[str, tuple[str, list[str]]] = {
    # Library holdings: one row per holding, call numbers with optional inner
    # space and an occasional " T" suffix.
    "holdings": ("orders", [
        f"{_s('o_custkey')} AS mms_id",
        f"{_s('o_orderkey')} AS holding_id",
        f"{_prefix(_HK)} || (CASE WHEN o_orderkey % 2 = 0 THEN ' ' ELSE '' END) || {_s(_HK)}"
        f" || (CASE WHEN o_orderkey % 13 = 5 THEN ' T' ELSE '' END) AS call_number",
        "o_orderkey AS row_ordinal",
    ]),
    # Inventory database: lower-case prefixes on some rows, NBSP on others.
    "inventory": ("orders", [
        "o_orderkey AS inventory_id",
        f"(CASE WHEN o_orderkey % 3 = 0 THEN lower({_prefix(_IK)}) ELSE {_prefix(_IK)} END)"
        f" || {_s(_IK)} || (CASE WHEN o_orderkey % 10 = 0 THEN chr(160) ELSE '' END) AS inventory_no",
        "'Title ' || " + _s("o_custkey") + " AS title",
        "(CASE WHEN o_orderkey % 7 = 0 THEN 'TELEVISION SERIES' WHEN o_orderkey % 7 = 1 THEN 'SHORT' "
        "WHEN o_orderkey % 7 = 2 THEN 'FEATURE FILM' WHEN o_orderkey % 7 = 3 THEN 'NEWSREEL' "
        "WHEN o_orderkey % 7 = 4 THEN 'COMPILATION' WHEN o_orderkey % 7 = 5 THEN 'DOCUMENTARY' "
        "ELSE '' END) AS production_type",
        "o_orderkey AS row_ordinal",
    ]),
    # Digital-asset records: raw keys, some blank, some with a " T" suffix.
    "digital": ("events", [
        "event_id AS pk",
        f"(CASE WHEN event_id % 97 = 96 THEN '' ELSE {_prefix(_DK)} || {_s(_DK)}"
        f" || (CASE WHEN event_id % 17 = 3 THEN ' T' ELSE '' END) END) AS inventory_number",
        "event_type AS carrier_a",
        "'LOC-' || " + _s("user_id") + " AS carrier_a_location",
        "(CASE WHEN event_id % 2 = 0 THEN 'HDD' ELSE '' END) AS carrier_b",
        "'' AS carrier_b_location",
        "'drive' || " + _s("user_id % 7") + " AS hard_drive_name",
        "'folder' || " + _s("event_id % 50") + " AS file_folder_name",
        "'' AS sub_folder_name",
        "'file_' || " + _s("event_id") + " || '.mov' AS file_name",
        "CAST(1 + event_id % 4 AS STRING) AS batch_number",
        "event_id AS row_ordinal",
    ]),
    # Spreadsheet column of extracted inventory numbers: singles, pipe-joined
    # pairs that share parts with neighbours, triples, and nulls.
    "sheet": ("customer", [
        "(CASE WHEN c_custkey % 5 = 4 THEN NULL "
        f"WHEN c_custkey % 5 = 3 THEN {_prefix('c_custkey * 7')} || {_s('c_custkey * 7')} || '|' || "
        f"{_prefix('c_custkey * 7 + 35')} || {_s('c_custkey * 7 + 35')} "
        f"WHEN c_custkey % 10 = 2 THEN {_prefix('c_custkey * 7')} || {_s('c_custkey * 7')} || '|' || "
        f"{_prefix('c_custkey * 7 + 1')} || {_s('c_custkey * 7 + 1')} || '|' || "
        f"{_prefix('c_custkey * 7 + 2')} || {_s('c_custkey * 7 + 2')} "
        f"ELSE {_prefix('c_custkey * 7')} || {_s('c_custkey * 7')} END) AS inventory_value",
        "c_custkey AS row_ordinal",
    ]),
}


_K = "o_orderkey"


def _blank_every(expr: str, k: str, p: int, r: int = 0, blank: str = "''") -> str:
    return f"(CASE WHEN {k} % {p} = {r} THEN {blank} ELSE {expr} END)"


def _ymd(ts: str) -> str:
    # Portable 'Y-M-D' text without zero padding (valid for strptime).
    return (f"CAST(year({ts}) AS STRING) || '-' || CAST(month({ts}) AS STRING) || '-' || "
            f"CAST(day({ts}) AS STRING)")


# Inventory records as seen by the validation layouts (analog and digital
# carriers share the table; digital_record tells them apart).
BINDINGS["layout_records"] = ("orders", [
    "o_orderkey AS inventory_id",
    _blank_every("'M' || CAST(o_orderkey AS STRING)", _K, 53) + " AS inventory_no",
    "'user' || CAST(o_orderkey % 9 AS STRING) AS user_last_modified",
    "CAST(CAST(o_orderdate AS DATE) AS STRING) AS date_modified",
    "(CASE WHEN o_orderkey % 3 = 0 THEN '1' ELSE '0' END) AS digital_record",
    "(CASE o_orderkey % 8 WHEN 0 THEN 'TELEVISION SERIES' WHEN 1 THEN 'television series ' "
    "WHEN 2 THEN '' WHEN 3 THEN 'SHORT' WHEN 4 THEN 'FEATURE FILM' WHEN 5 THEN NULL "
    "WHEN 6 THEN 'NEWSREEL' ELSE 'DOCUMENTARY' END) AS production_type",
    _blank_every("'English'", _K, 11, 0, "'  '") + " AS \"Language\"",
    _blank_every("'D' || CAST(o_custkey % 100 AS STRING)", _K, 13, 0, "NULL") + " AS donor_code",
    _blank_every("'Gift'", _K, 17, 1) + " AS \"Acquisition type\"",
    "o_orderstatus AS type",
    _blank_every("'1 reel'", _K, 19, 2) + " AS \"item holdings\"",
    _blank_every("'2 files'", _K, 23, 3) + " AS item_unit_holdings",
    _blank_every("'Title ' || CAST(o_custkey AS STRING)", _K, 29, 4) + " AS title",
    _blank_every("CAST(CAST(o_orderdate AS DATE) AS STRING)", _K, 31, 5) + " AS date_received",
    _blank_every("'Director ' || CAST(o_custkey % 50 AS STRING)", _K, 37, 6) + " AS director",
    "(CASE o_orderkey % 10 WHEN 0 THEN 'N/A' WHEN 1 THEN 'unknown' WHEN 2 THEN '' "
    "ELSE CAST(year(o_orderdate) AS STRING) END) AS release_broadcast_year",
    _blank_every("'16mm'", _K, 41, 7) + " AS format_type",
    "(CASE o_orderkey % 6 WHEN 0 THEN 'Temporary' WHEN 1 THEN 'PERMANENT' WHEN 2 THEN '' "
    "ELSE 'temporary' END) AS retention_status",
    _blank_every("'Video'", _K, 43, 8) + " AS asset_type",
    _blank_every("CAST(o_orderkey % 20 AS STRING)", _K, 4, 0) + " AS \"episode no.\"",
    _blank_every("'Episode ' || CAST(o_custkey AS STRING)", _K, 5, 0) + " AS episode_title",
    _blank_every(_ymd("o_orderdate"), _K, 7, 0) + " AS record_date",
    _blank_every(_ymd("o_orderdate"), _K, 4, 1) + " AS retention_start_date",
    _blank_every(_ymd("o_orderdate"), _K, 5, 1, "NULL") + " AS retention_end_date",
    "(CASE o_orderkey % 5 WHEN 0 THEN 'Preservation (Full)' WHEN 1 THEN 'ACCESS (CORE)' "
    "WHEN 2 THEN 'Access' ELSE '' END) AS object_purpose",
    _blank_every("'Stereo'", _K, 3, 2) + " AS \"sound_format(1)\"",
])

_L = "l_partkey"
# Child rows (items of a digital carrier) keyed by their parent record.
BINDINGS["carrier_items"] = ("lineitem", [
    "l_orderkey AS parent_id",
    "CAST(l_linenumber AS STRING) AS \"recordId\"",
    _blank_every("CAST(l_linenumber AS STRING)", "l_linenumber", 5) + " AS \"Item_unit_number\"",
    _blank_every("CAST(CAST(l_quantity AS BIGINT) AS STRING) || ' GB'", _L, 17, 0, "NULL")
    + " AS file_size_display",
    "(CASE l_partkey % 6 WHEN 0 THEN '' WHEN 1 THEN " + _ymd("l_shipdate") + " || '-1' "
    "WHEN 2 THEN CAST(year(l_shipdate) AS STRING) || '-13-01' WHEN 3 THEN '0000-01-01' "
    "ELSE " + _ymd("l_shipdate") + " END) AS \"Creation_date\"",
    _blank_every("l_returnflag", _L, 19, 2) + " AS audio_class",
    _blank_every("'/media/' || CAST(l_orderkey AS STRING) || '/' || CAST(l_linenumber AS STRING) || '.mov'",
                 _L, 23, 3, "'   '") + " AS file_path",
])

# Storage-format records and their carrier rows.
BINDINGS["storage_records"] = ("part", [
    "p_partkey AS storage_id",
    "p_partkey AS \"Inventory_id_fk\"",
    "'M' || CAST(p_partkey AS STRING) AS \"Inventory_no_fk\"",
    "'user' || CAST(p_size % 5 AS STRING) AS \"ModifiedBy\"",
    "'2024-01-' || CAST(1 + p_size % 28 AS STRING) AS \"ModificationTimestamp\"",
    _blank_every("p_brand", "p_partkey", 7, 0) + " AS \"Barcode\"",
    _blank_every("p_type", "p_partkey", 9, 1, "NULL") + " AS \"Location\"",
])

BINDINGS["storage_items"] = ("lineitem", [
    "l_partkey AS storage_id",
    _blank_every("'/store/' || CAST(l_orderkey AS STRING)", "l_orderkey", 11, 0) + " AS file_path",
    "(CASE WHEN l_suppkey % 13 = 0 THEN 0 ELSE CAST(l_quantity AS BIGINT) END) AS file_size",
])


# Records with a modification date, stored as a date and as text; every 13th
# text is no date.
BINDINGS["modified_records"] = ("orders", [
    "o_orderkey AS inventory_id", "CAST(o_orderdate AS DATE) AS modified_day",
    "(CASE WHEN o_orderkey % 13 = 0 THEN 'unknown' WHEN o_orderkey % 2 = 0 THEN "
    "lpad(CAST(month(o_orderdate) AS STRING), 2, '0') || '/' || lpad(CAST(day(o_orderdate) AS STRING), 2, '0') || '/' || "
    "CAST(year(o_orderdate) AS STRING) || ' 10:00:00' ELSE " + _ymd("o_orderdate") + " END) AS modified_text",
])
# Cells that tear a careless CSV: carriage returns, quotes, outer blanks,
# backslashes, empty and null.
BINDINGS["sheet_cells"] = ("part", [
    "p_partkey AS part_id",
    "p_type || chr(13) || p_brand AS production_type",
    "'  ' || p_name || '  ' AS padded",
    "'say \"' || p_name || '\", ok' AS quoted",
    "(CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'a' || chr(92) || 'b' || chr(92) END) AS rest",
])


# One key, the blank one, holds a third of the rows.
BINDINGS["hot_holdings"] = ("orders", [
    "CAST(o_orderkey AS STRING) AS holding_id",
    "(CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'M' || CAST(o_orderkey % 4999 AS STRING) END) AS call_number",
    "o_orderkey AS row_ordinal",
])
BINDINGS["hot_inventory"] = ("orders", [
    "o_orderkey AS inventory_id",
    "(CASE WHEN o_orderkey % 3 = 1 THEN 'M0' ELSE 'M' || CAST(o_orderkey % 7001 AS STRING) END) AS inventory_no",
])
BINDINGS["hot_resources"] = ("lineitem", [
    "l_orderkey AS pk",
    "(CASE WHEN l_orderkey % 3 = 0 THEN 'M0' ELSE 'M' || CAST(l_partkey % 9001 AS STRING) END) AS inventory_number",
    "l_linenumber AS line",
])


def binding_sql(name: str) -> str:
    """SELECT statement of a binding (usable as a CTE body in DuckDB)."""
    table, exprs = BINDINGS[name]
    return f"SELECT {', '.join(exprs)} FROM {table}"


def cte(*names: str) -> str:
    """``WITH a AS (...), b AS (...)`` prefix for oracle SQL."""
    return "WITH " + ",\n".join(f"{n} AS ({binding_sql(n)})" for n in names) + "\n"


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Lazy scan of one test table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Derive a binding from the test tables (column pruning reaches the scan)."""
    table, exprs = BINDINGS[name]
    # Spark SQL quotes identifiers with backticks, DuckDB with double quotes.
    exprs = [re.sub(r'AS "([^"]+)"$', r"AS `\1`", e) for e in exprs]
    return read_table(spark, sf_dir, table).selectExpr(*exprs)


# ---------------------------------------------------------------------------
# Dirty text derived from clean values (standardisation inputs)
# ---------------------------------------------------------------------------

_Y = "CAST(year(o_orderdate) AS STRING)"
_M = "CAST(month(o_orderdate) AS STRING)"
_D = "CAST(day(o_orderdate) AS STRING)"
_NEXT2 = "lpad(CAST((year(o_orderdate) + 1) % 100 AS STRING), 2, '0')"


def month_name(m: str) -> str:
    names = ["January", "February", "March", "April", "May", "June", "July", "August",
             "September", "October", "November", "December"]
    return "(CASE " + " ".join(f"WHEN {m} = {i + 1} THEN '{n}'" for i, n in enumerate(names)) + " END)"


_MN = month_name("month(o_orderdate)")

BINDINGS["dated_records"] = ("orders", [
    "o_orderkey AS inventory_id",
    "o_orderdate AS clean_date",
    "(CASE o_orderkey % 10 "
    f"WHEN 0 THEN 'ca. ' || {_Y} "
    f"WHEN 1 THEN '[' || {_Y} || ']' "
    f"WHEN 2 THEN {_M} || '/' || {_D} || '/' || {_Y} "
    f"WHEN 3 THEN 'c ' || {_Y} "
    f"WHEN 4 THEN {_Y} || '-' || {_NEXT2} "
    f"WHEN 5 THEN {_MN} || ' ' || {_Y} "
    f"WHEN 6 THEN {_MN} || ' ' || {_D} || ', ' || {_Y} "
    f"WHEN 7 THEN substr({_Y}, 1, 3) || '0s' "
    "WHEN 8 THEN 'UNKNOWN' "
    f"ELSE {_Y} || ' ; ' || CAST(year(o_orderdate) + 1 AS STRING) END) AS record_date",
    "(CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'n/a' "
    f"WHEN 2 THEN {_Y} ELSE '[' || {_Y} || ']' END) AS release_broadcast_year",
])

_C2 = f"substr({_Y}, 1, 2)"
_C3 = f"substr({_Y}, 1, 3)"
_NEXT = "CAST(year(o_orderdate) + 1 AS STRING)"

BINDINGS["partial_records"] = ("orders", [
    "o_orderkey AS inventory_id",
    "o_orderdate AS clean_date",
    "(CASE o_orderkey % 16 "
    f"WHEN 0 THEN {_C3} || 'u' "
    f"WHEN 1 THEN {_C2} || 'UU' "
    f"WHEN 2 THEN {_C2} || 'uu-' || {_Y} "
    f"WHEN 3 THEN {_C3} || 'U-UUUU' "
    f"WHEN 4 THEN {_Y} || '-UUUU' "
    f"WHEN 5 THEN {_C2} || 'XX' "
    f"WHEN 6 THEN 'C. ' || {_C3} || '0s' "
    f"WHEN 7 THEN 'CIRCA ' || {_Y} || '-' || {_NEXT} "
    f"WHEN 8 THEN 'shown ca. ' || {_Y} "
    f"WHEN 9 THEN {_M} || '/00/' || {_Y} "
    f"WHEN 10 THEN {_M} || '-' || {_D} || '-' || substr({_Y}, 3, 2) "
    f"WHEN 11 THEN {_D} || 'th ' || {_MN} || ' ' || {_Y} "
    f"WHEN 12 THEN {_Y} || '/' || {_NEXT} "
    f"WHEN 13 THEN {_MN} || ' 3 & 4, ' || {_Y} "
    f"WHEN 14 THEN {_C3} || '0''s?' "
    f"ELSE {_Y} || ' circa' END) AS record_date",
])

BINDINGS["typed_parts"] = ("part", [
    "p_partkey AS part_id",
    "p_type AS clean_type",
    "(CASE p_partkey % 6 WHEN 0 THEN lower(p_type) "
    "WHEN 1 THEN p_type || ' ' || lower(p_type) "
    "WHEN 2 THEN 'SF ' || chr(13) || p_type "
    "WHEN 3 THEN 'B&W' || chr(13) || p_type || ' & SHORT' "
    "WHEN 4 THEN 'Newsreel' || chr(13) || p_type "
    "ELSE p_type || ';Made for TV Movies' END) AS production_type",
])

_LANGS = ["French", "German", "English", "Spanish", "Italian", "Russian", "Japanese", "Portuguese"]


def language_name(i: str) -> str:
    return "(CASE " + " ".join(f"WHEN {i} = {k} THEN '{n}'" for k, n in enumerate(_LANGS)) + " END)"


_L1 = language_name("c_nationkey % 8")
_L2 = language_name("(c_nationkey + 1) % 8")

BINDINGS["language_records"] = ("customer", [
    "c_custkey AS customer_id",
    f"{_L1} AS clean_language",
    f"{_L2} AS clean_language2",
    "(CASE c_custkey % 5 "
    f"WHEN 0 THEN lower({_L1}) "
    f"WHEN 1 THEN upper({_L1}) || ' / ' || {_L2} "
    f"WHEN 2 THEN substr({_L1}, 1, 2) || substr({_L1}, 4) "
    f"WHEN 3 THEN {_L1} || ' Intertitles' "
    "ELSE '?' END) AS \"Language\"",
])


def _cap(w: str) -> str:
    return f"(upper(substr({w}, 1, 1)) || substr({w}, 2))"


_W1 = "split_part(p_name, ' ', 1)"
_W2 = "split_part(p_name, ' ', 2)"

BINDINGS["director_parts"] = ("part", [
    "p_partkey AS part_id",
    "p_name AS clean_name",
    "(CASE p_partkey % 6 WHEN 0 THEN upper(p_name) WHEN 1 THEN p_name "
    f"WHEN 2 THEN 'Someone (as ' || {_cap(_W1)} || ' ' || {_cap(_W2)} || ')' "
    f"WHEN 3 THEN {_cap(_W1)} || ' ' || {_cap(_W2)} || ' aka Other' "
    f"WHEN 4 THEN {_cap(_W1)} || ' & ' || {_cap(_W2)} "
    "ELSE 'NULL' END) AS director",
])


# ---------------------------------------------------------------------------
# Paths, assets, items (file and asset operators)
# ---------------------------------------------------------------------------

_PK = "(o_orderkey + 10)"

BINDINGS["legacy_paths"] = ("orders", [
    "o_orderkey AS row_index",
    f"(CASE o_orderkey % 6 "
    f"WHEN 0 THEN {_prefix(_PK)} || CAST({_PK} AS STRING) || '_Title_Reel' "
    f"WHEN 1 THEN {_prefix(_PK)} || CAST({_PK} AS STRING) || 'T_KTLA' "
    f"WHEN 2 THEN 'Show_T' || CAST({_PK} AS STRING) || '_Part' "
    f"WHEN 3 THEN {_prefix(_PK)} || CAST({_PK} AS STRING) || 'M_XFF' || CAST({_PK} + 1 AS STRING) || 'M_Final' "
    f"WHEN 4 THEN 'Max_From_DVD_H264' "
    f"ELSE 'AAC442' || chr(92) || 'Title_T01ASYNC_M' || CAST({_PK} AS STRING) END) AS legacy_path",
])

_EXT = "(CASE page_id % 5 WHEN 0 THEN '.mov' WHEN 1 THEN '.MP4' WHEN 2 THEN '.json' ELSE '' END)"
BINDINGS["file_lists"] = ("pages", [
    "page_id",
    "(CASE WHEN page_id % 7 = 6 THEN ' vol4/.hidden ' "
    "ELSE 'vol' || CAST(page_id % 3 AS STRING) || '/sub/f' || CAST(page_id % 97 AS STRING) || "
    f"{_EXT} END) AS path",
])

BINDINGS["asset_files"] = ("documents", [
    "'doc-' || CAST(doc_id AS STRING) AS uuid",
    "(CASE WHEN doc_id % 6 = 0 THEN '' ELSE 'f' || CAST(doc_id % 89 AS STRING) || "
    "(CASE WHEN doc_id % 2 = 0 THEN '.mov' ELSE '.MP4' END) END) AS file_name",
])

BINDINGS["batch_assets"] = ("lineitem", [
    "'a' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS uuid",
    "(CASE WHEN l_linenumber = 1 THEN 'asset' ELSE 'track' END) AS record_type",
    "(CASE WHEN l_linenumber % 4 = 3 THEN 'M' || CAST(l_orderkey + 1 AS STRING) "
    "ELSE 'M' || CAST(l_orderkey AS STRING) END) || '|X' || CAST(l_partkey AS STRING) AS inventory_numbers_text",
    "(CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber % 3 = 2 THEN '' "
    "ELSE 'a' || CAST((CASE WHEN l_linenumber % 5 = 4 THEN l_orderkey + 100000000 ELSE l_orderkey END) AS STRING)"
    " || '-1' END) AS match_asset",
    "l_orderkey * 10 + l_linenumber AS row_ordinal",
])

BINDINGS["media_items"] = ("lineitem", [
    "'it-' || CAST(l_orderkey AS STRING) || '-' || "
    "CAST((CASE WHEN l_linenumber = 7 THEN 6 ELSE l_linenumber END) AS STRING) AS item_uuid",
    "(CASE WHEN l_linenumber = 5 THEN l_orderkey + 100000000 ELSE l_orderkey END) AS inventory_id_fk",
])

BINDINGS["media_batch"] = ("events", [
    "'it-' || CAST(event_id AS STRING) || '-' || CAST(1 + event_id % 7 AS STRING) AS uuid",
    "(CASE WHEN event_id % 4 = 0 THEN '  ' "
    "ELSE ' it-' || CAST(event_id + 1 AS STRING) || '-1 ' END) AS match_asset_uuid",
])


# ---------------------------------------------------------------------------
# Bibliographic records (flat; assembled into MARC structs by plans.marc_fixture)
# ---------------------------------------------------------------------------

def _capw(w: str) -> str:
    return f"(upper(substr({w}, 1, 1)) || substr({w}, 2))"


_PW1, _PW2 = "split_part(p_name, ' ', 1)", "split_part(p_name, ' ', 2)"
_PNAME = f"({_capw(_PW1)} || ' ' || {_capw(_PW2)})"
_LANG3 = ("(CASE p_size % 6 WHEN 0 THEN 'eng' WHEN 1 THEN 'fra' WHEN 2 THEN '   ' "
          "WHEN 3 THEN 'xxx' WHEN 4 THEN 'ger' ELSE 'jap' END)")

BINDINGS["bib_flat"] = ("part", [
    "CAST(p_partkey AS STRING) AS bib_id",
    "(CASE p_partkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '850101s' || CAST(p_size AS STRING) "
    "WHEN 2 THEN rpad('', 40, ' ') "
    f"ELSE rpad('850101s1995', 35, ' ') || {_LANG3} || ' d' END) AS f008",
    "(CASE p_partkey % 5 WHEN 0 THEN '0' WHEN 1 THEN '4' WHEN 2 THEN '2' WHEN 3 THEN ' ' ELSE '3' END) AS ind2",
    "(CASE p_partkey % 4 WHEN 0 THEN 'The ' || p_name || ' /' WHEN 1 THEN 'A ' || p_name || ' :' "
    "WHEN 2 THEN p_name || '.' ELSE 'An ' || p_name END) AS a245",
    "(CASE WHEN p_partkey % 3 = 0 THEN p_brand || ' ;' END) AS b245",
    "(CASE WHEN p_partkey % 11 = 0 THEN 'Part ' || CAST(p_size AS STRING) END) AS n245",
    "(CASE WHEN p_partkey % 13 = 0 THEN 'Episode ' || CAST(p_size AS STRING) END) AS p245",
    f"(CASE p_partkey % 6 WHEN 0 THEN 'directed by ' || {_PNAME} "
    f"WHEN 1 THEN 'a film by ' || {_PNAME} || '; produced by Studio' "
    f"WHEN 2 THEN 'technical director ' || {_PNAME} WHEN 3 THEN NULL "
    f"WHEN 4 THEN 'directed by ' || {_capw(_PW1)} || ' and ' || {_capw(_PW2)} "
    f"ELSE 'producer ' || {_PNAME} END) AS c245",
    f"(CASE p_partkey % 6 WHEN 4 THEN {_capw(_PW1)} WHEN 3 THEN NULL ELSE {_PNAME} END) AS person1",
    f"(CASE WHEN p_partkey % 6 = 4 THEN {_capw(_PW2)} END) AS person2",
    "(CASE WHEN p_partkey % 8 = 0 THEN '1995' WHEN p_partkey % 8 = 1 THEN ' ' END) AS c260",
    "(CASE WHEN p_partkey % 9 = 0 THEN '[199-]' END) AS c264",
    "(CASE WHEN p_partkey % 10 = 0 THEN '2nd ed.' END) AS a250",
    "(CASE WHEN p_partkey % 12 = 0 THEN 'Contents' END) AS a505",
    "(CASE WHEN p_partkey % 5 = 1 THEN 'Alt ' || p_name END) AS a246",
    "(CASE p_partkey % 9 WHEN 0 THEN 'Feature films.' WHEN 1 THEN 'Shorts' WHEN 2 THEN 'Newsreels' "
    "WHEN 3 THEN 'Cartoons.' WHEN 4 THEN 'Student films and video' WHEN 5 THEN 'Anthologies' "
    "WHEN 6 THEN 'Documentaries and factual films and video' END) AS form1",
    "(CASE WHEN p_partkey % 9 = 4 AND p_size % 2 = 0 THEN 'local' END) AS form1_source",
    "(CASE WHEN p_partkey % 9 = 5 THEN 'Short films' "
    "WHEN p_partkey % 9 = 0 AND p_size % 3 = 0 THEN 'Animated films' END) AS form2",
    "(CASE WHEN p_partkey % 4 = 2 THEN 'eng' || 'fre' END) AS a041",
    "(CASE WHEN p_partkey % 7 = 3 THEN 'Series ' || p_brand END) AS a490",
    "p_partkey AS row_ordinal",
])

BINDINGS["language_codes"] = ("nation", [
    "(CASE n_nationkey % 6 WHEN 0 THEN 'eng' WHEN 1 THEN 'fra' WHEN 2 THEN 'ger' WHEN 3 THEN 'spa' "
    "WHEN 4 THEN 'ita' ELSE 'rus' END) AS code",
    "'Language of ' || n_name AS name",
    "n_nationkey AS row_ordinal",
])
