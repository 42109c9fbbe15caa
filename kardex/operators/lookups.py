"""Lookups between sources.

All are equi-joins against a side that is first reduced to one row per key
with a partial aggregate (``count`` + ``min_by``/``max_by``), so a hot key on
the probe side meets a single build row and AQE can split it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kardex.functions import marc as MC
from kardex.functions._util import as_col, lit_array
from kardex.functions.text import blank_to_null, inventory_key, strip
from kardex.operators.numbering import number_within
from kardex.operators.keys import keep_last, one_per_key


# ---------------------------------------------------------------------------
# H4: inventory codes inside free text
# ---------------------------------------------------------------------------

# Code pattern (prefixes, 2+ digits, optional one-letter suffix
# not followed by a letter) and the known false positive.
CODE_PATTERN = r"(?<![A-Z])(?:M|T|DVD|FE|HFA|VA|XFE|XFF|XVE)\d{2,}(?:[A-Z](?![A-Za-z]))?"
FALSE_POSITIVES = ["T01"]


def extract_codes(c, false_positives=FALSE_POSITIVES) -> Column:
    """H4: all codes in order of first appearance, minus known false
    positives, ``|``-joined; no match -> ``""``; null -> null."""
    c = as_col(c)
    found = F.array_distinct(F.regexp_extract_all(c, F.lit(CODE_PATTERN), 0))
    kept = F.array_except(found, lit_array(false_positives)) if false_positives else found
    return F.when(c.isNotNull(), F.array_join(kept, "|"))


# ---------------------------------------------------------------------------
# First suffix variant that hits
# ---------------------------------------------------------------------------

SUFFIX_ORDER = ["", "T", "M", "R"]


def first_suffix_match(keys: DataFrame, index: DataFrame, key: str = "key",
                       index_key: str = "call_key", index_id: str = "bib_id",
                       suffixes=SUFFIX_ORDER, accept=None) -> DataFrame:
    """Try ``key``, ``key+T``, ``key+M``, ``key+R`` in order and keep the
    first that finds an index row (lowest id among equal hits).

    Output: ``key, matched_key, <index_id>, suffixed``.  ``accept`` is an
    optional Column predicate over the joined row (e.g. a library filter).
    """
    cands = keys.select(F.col(key).alias("__key"),
                        F.posexplode(F.array(*[F.concat(F.col(key), F.lit(s)) for s in suffixes])).alias("__prio", "__cand"))
    if accept is None:
        # Only the lowest id per call key can win: reduce the index first
        # (partial aggregation), so a hot call key meets one row, not all.
        idx = index.groupBy(F.col(index_key).alias("__cand")).agg(F.min(F.col(index_id)).alias("__id"))
    else:
        idx = index.select(F.col(index_key).alias("__cand"), F.col(index_id).alias("__id"), *(
            [c for c in index.columns if c not in (index_key, index_id)]))
    hits = cands.join(idx, "__cand")
    if accept is not None:
        hits = hits.filter(accept)
    best = hits.groupBy("__key").agg(F.min_by(F.struct("__cand", "__id", "__prio"),
                                              F.struct("__prio", "__id")).alias("b"))
    return best.select(F.col("__key").alias(key), F.col("b.__cand").alias("matched_key"),
                       F.col("b.__id").alias(index_id), (F.col("b.__prio") > 0).alias("suffixed"))


# ---------------------------------------------------------------------------
# Exactly-one lookups
# ---------------------------------------------------------------------------

def attach_bib(df: DataFrame, bibs: DataFrame, key: str, bib_key: str = "bib_id",
               ordinal: str | None = None) -> DataFrame:
    """Left join by bib id; a duplicate bib id keeps the last one;
    ``bib_missing`` flags rows without a bib (reported, not an error)."""
    if ordinal:
        b = keep_last(bibs, bib_key, ordinal)
    else:
        # No order given: still one bib per id, so the join never pairs rows.
        cols = [F.col(f"`{c}`") for c in bibs.columns]
        b = bibs.groupBy(F.col(bib_key).alias("__bk")).agg(F.any_value(F.struct(*cols)).alias("__b")).select("__b.*")
    b = b.withColumn("__has_bib", F.lit(True))
    out = df.join(b, F.col(key) == b[bib_key], "left")
    return out.withColumn("bib_missing", F.col("__has_bib").isNull()).drop("__has_bib")


def lookup_exactly_one(keys: DataFrame, table: DataFrame, key: str, table_key: str,
                       prefix: str, cols) -> DataFrame:
    """Per key, status ``missing`` / ``ambiguous`` / ``ok`` and the
    matched row's ``cols`` (prefixed) when ok.  Status rows replace the
    reference's process exit."""
    agg = one_per_key(table, F.col(f"`{table_key}`"), "__tk", F.count(F.lit(1)).alias("__n"),
                      F.any_value(F.struct(*[F.col(f"`{c}`").alias(c) for c in cols])).alias("__row"))
    j = keys.join(agg, F.col(f"`{key}`") == F.col("__tk"), "left")
    status = (F.when(F.col("__n").isNull(), "missing")
               .when(F.col("__n") > 1, "ambiguous").otherwise("ok"))
    sel = [F.when(F.col("__n") == 1, F.col("__row")[c]).alias(f"{prefix}{c}") for c in cols]
    return j.select(*[F.col(f"`{c}`") for c in keys.columns], status.alias(f"{prefix}status"), *sel)


def assemble_new_media(batch: DataFrame, items: DataFrame, inventory: DataFrame,
                       bib_index: DataFrame | None = None) -> DataFrame:
    """Batch row -> item by UUID (exactly one) -> inventory by
    ``inventory_id_fk`` (exactly one) -> optional bib by J5; ``match_asset``
    is the blank-to-null of the batch column."""
    b = batch.select("uuid", blank_to_null(F.col("match_asset_uuid")).alias("match_asset"))
    s1 = lookup_exactly_one(b, items, "uuid", "item_uuid", "item_", ["inventory_id_fk"])
    s2 = lookup_exactly_one(s1, inventory, "item_inventory_id_fk", "inventory_id", "inv_",
                            ["inventory_id", "inventory_no"])
    status = (F.when(F.col("item_status") != "ok", F.concat(F.lit("item "), F.col("item_status")))
               .when(F.col("inv_status") != "ok", F.concat(F.lit("inventory "), F.col("inv_status")))
               .otherwise("ok"))
    out = s2.select("uuid", "match_asset", status.alias("status"), "inv_inventory_id", "inv_inventory_no")
    if bib_index is not None:
        # Catalog call numbers are searched case-insensitively: use the
        # normalised inventory key.
        out = out.withColumn("__k", inventory_key(F.col("inv_inventory_no")))
        keys = out.select(F.col("__k").alias("key")).filter(F.col("key").isNotNull()).distinct()
        m = first_suffix_match(keys, bib_index)
        out = out.join(m.withColumnRenamed("key", "__k"), "__k", "left").drop("__k")
    return out


def batch_records(digital: DataFrame, batch: str, col: str = "batch_number") -> DataFrame:
    """P10: digital records of one batch number (paging is an API concern)."""
    return digital.filter(F.col(col) == F.lit(batch))


def assemble_sources(digital: DataFrame, inventory: DataFrame, bib_index: DataFrame | None = None,
                     *, digital_key="inventory_number", inv_key="inv_key",
                     inv_ordinal="row_ordinal") -> tuple[DataFrame, DataFrame]:
    """Digital record + first inventory row for its number (required) +
    optional bib by J5.  Returns ``(assembled, errors)``; digital rows
    without an inventory row go to ``errors`` (anti join)."""
    cols = [c for c in inventory.columns]
    first_inv = one_per_key(inventory, inv_key, "__k",
                            F.min_by(F.struct(*[F.col(c) for c in cols]), F.col(inv_ordinal)).alias("inv"))
    d = digital.withColumn("__k", F.col(digital_key))
    assembled = d.join(first_inv, "__k")
    errors = (d.join(first_inv.select("__k"), "__k", "left_anti")
               .withColumn("error", F.concat(F.lit("No inventory record found for inventory number '"),
                                             F.col(digital_key), F.lit("'")))
               .drop("__k"))
    if bib_index is not None:
        keys = assembled.select(F.col("__k").alias("key")).distinct()
        m = first_suffix_match(keys, bib_index)
        assembled = assembled.join(m.withColumnRenamed("key", "__k"), "__k", "left")
        assembled = assembled.withColumn("bib_missing", F.col("bib_id").isNull())
    return assembled.drop("__k"), errors


# ---------------------------------------------------------------------------
# match_asset links inside a batch
# ---------------------------------------------------------------------------

def validate_links(assets: DataFrame, check_keys: bool = True, *, uuid="uuid",
                   match_asset="match_asset", numbers="inventory_numbers",
                   record_type="record_type", ordinal="row_ordinal") -> DataFrame:
    """One problem row per asset whose ``match_asset`` target is not in
    the batch, or (``check_keys``) whose first inventory number differs from
    the target's.  Duplicate uuids: the last one wins as link target."""
    targets = keep_last(assets.filter(F.coalesce(F.col(uuid), F.lit("")) != ""), uuid, ordinal).select(
        F.col(uuid).alias("__t_uuid"), F.get(F.col(numbers), 0).alias("__t_inv"),
        F.col(record_type).alias("__t_type"))
    src = assets.filter(F.coalesce(F.col(match_asset), F.lit("")) != "")
    j = src.join(targets, F.col(match_asset) == F.col("__t_uuid"), "left")
    inv = F.get(F.col(numbers), 0)
    missing = F.format_string("Match asset %s for record %s not found in batch.", F.col(match_asset), F.col(uuid))
    py = lambda c: F.coalesce(c, F.lit("None"))  # noqa: E731  (str(None) in messages)
    differ = F.format_string(
        "Inventory numbers do not match for match_asset relationship: %s %s: '%s', %s %s: '%s'",
        F.col(record_type), F.col(uuid), py(inv), F.col("__t_type"), F.col("__t_uuid"), py(F.col("__t_inv")))
    problem = F.when(F.col("__t_uuid").isNull(), missing)
    if check_keys:
        problem = problem.when(~inv.eqNullSafe(F.col("__t_inv")), differ)
    return j.select(F.col(uuid).alias("uuid"), problem.alias("problem")).filter(F.col("problem").isNotNull())


def count_by_type(assets: DataFrame, record_type: str = "record_type") -> DataFrame:
    """Asset and track counts in one pass."""
    return assets.agg(F.count_if(F.col(record_type) == "asset").alias("assets"),
                      F.count_if(F.col(record_type) == "track").alias("tracks"))


# ---------------------------------------------------------------------------
# Nested matches
# ---------------------------------------------------------------------------

def _matchable_rows(rows: DataFrame, row_id: str, row_no: str) -> DataFrame:
    return rows.filter((F.coalesce(strip(F.col(row_id).cast("string")), F.lit("")) != "")
                       & (F.coalesce(strip(F.col(row_no)), F.lit("")) != ""))


def _matches(rows: DataFrame, resources: DataFrame, row_id: str, row_no: str, res_no: str) -> tuple[DataFrame, DataFrame]:
    """``match_resources``, its resources with ``__id`` too: the id of their
    number's row where there is exactly one."""
    r = _matchable_rows(rows, row_id, row_no)
    n = F.count(F.lit(1))
    keys = one_per_key(r, row_no, "__k", n.alias("inventory_rows"), F.when(n == 1, F.min(F.col(row_id))).alias("__id"))
    key_resources = (resources.join(keys, F.col(res_no) == F.col("__k")).drop("__k"))
    res_keys = one_per_key(resources, res_no, "__k", F.count(F.lit(1)).alias("resources"))
    row_matches = r.join(res_keys, F.col(row_no) == F.col("__k")).drop("__k")
    return row_matches, key_resources


def match_resources(rows: DataFrame, resources: DataFrame, *, row_id="inventory_id",
                    row_no="inventory_no", res_no="Inventory_no") -> tuple[DataFrame, DataFrame]:
    """J8 (long form, key level): ``(row_matches, key_resources)``.

    ``row_matches``: inventory rows (non-blank id and number) that have at
    least one resource of equal number, with ``resources`` (how many).
    ``key_resources``: every
    resource whose number has at least one such row, with ``inventory_rows``
    (how many rows share the number).  Together they describe every nested
    document without materialising row x resource pairs: the row side is
    reduced to one row per number (partial aggregation) before the join.
    """
    row_matches, key_resources = _matches(rows, resources, row_id, row_no, res_no)
    return row_matches, key_resources.drop("__id")


def nested_parts(rows: DataFrame, resources: DataFrame, resource_cols, *, row_id="inventory_id",
                 row_no="inventory_no", res_no="Inventory_no", part_size: int = 1000) -> DataFrame:
    """J8 (document form, input to K6): the rows and the resources of each
    matched number as one or more documents
    ``inventory_no, part, rows array<id>, matched_resources array<struct>``.

    A number with more than ``part_size`` rows or resources has several parts.
    Rows and resources are numbered within their number, so that no list is
    longer than ``part_size``, however many of them are equal; every row and
    resource is in exactly one part.  A resource carries the
    ``inventory_id`` of its number's row where there is exactly one.
    """
    # One join only: a second one on the number would keep AQE from splitting a hot number's rows.
    row_matches, key_resources = _matches(rows, resources, row_id, row_no, res_no)
    part = F.floor(F.col("__place") / part_size).alias("part")
    item = F.struct(F.col("__id").alias(row_id), *[F.col(c) for c in resource_cols])
    held = key_resources.select(F.col(res_no).alias("inventory_no"), item.alias("item"))
    held = number_within(held, "inventory_no", "__place").select("inventory_no", part, "item")
    owners = row_matches.select(F.col(row_no).alias("inventory_no"), F.col(row_id).alias("id"))
    owners = number_within(owners, "inventory_no", "__place").select("inventory_no", part, "id")
    return (held.unionByName(owners, allowMissingColumns=True).groupBy("inventory_no", "part").agg(
        F.array_sort(F.collect_list("id")).alias("rows"),
        F.array_sort(F.collect_list("item")).alias("matched_resources")))


def monograph_flags(matched: DataFrame, bibs: DataFrame, key: str = "mms_id", ordinal: str = "row_ordinal") -> DataFrame:
    """Matched rows with their bib (a bib id that repeats keeps its
    last record, J7) and the flags ``bib_missing``, ``monograph`` and
    ``form_mismatch``; ``c`` holds the compared forms (G4)."""
    b = attach_bib(matched, bibs, key, ordinal=ordinal)
    b = b.withColumn("monograph", ~F.col("bib_missing") & F.coalesce(
        MC.is_monograph(F.col("production_type")), F.lit(False))).withColumn(
        "c", MC.compare_forms(MC.bib_forms(), MC.inventory_forms(F.col("production_type"))))
    differ = (F.size("c.unique_bib") > 0) | (F.size("c.unique_inventory") > 0)
    return b.withColumn("form_mismatch", F.col("monograph") & F.coalesce(differ, F.lit(False)))


# ---------------------------------------------------------------------------
# Code membership
# ---------------------------------------------------------------------------

def valid_code_check(df: DataFrame, code_col: str, codes: DataFrame, code_key: str = "code") -> DataFrame:
    """``code_valid`` = the code is in the code table.  The code list is
    small; AQE broadcasts it only when its runtime size is under the
    configured threshold (no forced hint)."""
    c = codes.select(F.col(code_key).alias("__code")).distinct().withColumn("__ok", F.lit(True))
    return (df.join(c, F.col(code_col) == F.col("__code"), "left")
              .withColumn("code_valid", F.coalesce(F.col("__ok"), F.lit(False))).drop("__code", "__ok"))
