"""Declarative record validation.

A layout is data: required fields, child-row fields, cross-field rules and the
per-layout names of the id/number/user/date columns.  ``violations`` turns a
layout into one projection per record: an ``array<struct<field, violation>>``
with a ``when`` per rule, filtered and exploded - map-only, no shuffle.  Child
rows come either as an ``array<struct>`` column (exploded) or as a separate
table joined to the in-scope parents on their key.

Three kinds of missing: a required column absent from the DataFrame skips the
rule at plan-build time; null, blank and numeric 0 count as a violation.  In
cross-field rules an absent column reads as blank.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kardex.functions._util import as_col
from kardex.functions.text import strip
from kardex.operators.keys import require_columns

NULL_MESSAGE = "Field is null or empty."
REPORT_COLUMNS = ["inventory_id", "inventory_no", "field", "user_last_modified",
                  "date_modified", "violation"]


@dataclass(frozen=True)
class Layout:
    name: str
    required: tuple[str, ...]
    meta: dict = field(default_factory=dict)  # report column -> source column
    digital_record: str | None = None  # P2 scope value, None = no filter
    child_required: tuple[str, ...] = ()
    child_dates: tuple[str, ...] = ()
    cross_rules: tuple[str, ...] = ()


_STD_META = {"inventory_id": "inventory_id", "inventory_no": "inventory_no",
             "user_last_modified": "user_last_modified", "date_modified": "date_modified"}

# Layouts, their required fields, child-row fields and rules.
LAYOUTS: dict[str, Layout] = {
    "InventoryForLabeling_API": Layout(
        name="InventoryForLabeling_API",
        required=("production_type", "Language", "donor_code", "Acquisition type", "type",
                  "item holdings", "title", "date_received", "director",
                  "release_broadcast_year", "format_type", "inventory_no"),
        meta=_STD_META, digital_record="0",
        cross_rules=("tv_series", "unknown_year")),
    "NEW DIGITAL_API": Layout(
        name="NEW DIGITAL_API",
        required=("production_type", "Language", "donor_code", "Acquisition type", "type",
                  "item_unit_holdings", "title", "date_received", "director",
                  "release_broadcast_year", "retention_status", "asset_type"),
        meta=_STD_META, digital_record="1",
        child_required=("Item_unit_number", "file_size_display", "Creation_date",
                        "audio_class", "file_path"),
        child_dates=("Creation_date",),
        cross_rules=("tv_series", "unknown_year", "temporary_retention", "sound_format")),
    "NEW DIGITAL STORAGE_API": Layout(
        name="NEW DIGITAL STORAGE_API",
        required=("Barcode", "Location"),
        meta={"inventory_id": "Inventory_id_fk", "inventory_no": "Inventory_no_fk",
              "user_last_modified": "ModifiedBy", "date_modified": "ModificationTimestamp"},
        digital_record=None,
        child_required=("file_path", "file_size")),
}


# --------------------------------------------------------------------------
# value helpers
# --------------------------------------------------------------------------

def _is_numeric(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.NumericType)


def field_text(df: DataFrame, name: str) -> Column:
    """``str(value or "").strip()``: absent, null, numeric 0 -> ``""`` (Q8)."""
    if name not in df.columns:
        return F.lit("")
    c = F.col(f"`{name}`")
    if _is_numeric(df, name):
        return F.when(c.isNull() | (c == 0), F.lit("")).otherwise(c.cast("string"))
    if isinstance(df.schema[name].dataType, T.BooleanType):
        return F.when(c.isNull() | ~c, F.lit("")).otherwise(F.lit("True"))
    return F.coalesce(strip(c.cast("string")), F.lit(""))


def value_is_blank(df: DataFrame, name: str) -> Column:
    """H2 with Q8: null, empty, whitespace only or numeric 0."""
    return field_text(df, name) == ""


def py_repr(c: Column) -> Column:
    """Python ``repr`` of a short string (quotes and backslashes)."""
    esc = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for ch, rep in (("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        esc = F.replace(esc, F.lit(ch), F.lit(rep))
    dq = c.contains("'") & ~c.contains('"')
    return F.when(dq, F.concat(F.lit('"'), esc, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(esc, F.lit("'"), F.lit("\\'")), F.lit("'")))


def is_valid_date(c: Column) -> Column:
    """V2: ``strptime(v, "%Y-%m-%d")``: 4-digit year >= 1, 1-2 digit month
    and day, a real calendar date."""
    c = F.coalesce(c, F.lit(""))
    # Month 1-12 and day 1-31 are checked by the pattern; only day-of-month
    # overflow (Feb 30) reaches the parser, whose failure path is costly.
    shape = (c.rlike(r"^[0-9]{4}-(0?[1-9]|1[0-2])-(0?[1-9]|[12][0-9]|3[01])$")
             & ~c.startswith("0000"))
    day = F.regexp_extract(c, r"-([0-9]{1,2})$", 1)
    needs_parse = shape & (day.cast("int") > 28)
    return shape & (~needs_parse | F.try_to_date(F.when(needs_parse, c), "yyyy-M-d").isNotNull())


def date_message(c: Column) -> Column:
    return F.concat(F.lit("Field value "), py_repr(c),
                    F.lit(" is not a valid date in YYYY-MM-DD format."))


# --------------------------------------------------------------------------
# P1-P3 scope filters
# --------------------------------------------------------------------------

#: Forms in which dates are stored and passed, tried in this order.
DATE_FORMS = ["yyyy-M-d", "M/d/yyyy", "M/d/yyyy H:m:s", "yyyy-M-d H:m:s", "yyyy-M-d'T'H:m:s"]


def to_day(c: Column) -> Column:
    """The date of a text in one of ``DATE_FORMS``; null if in none."""
    return F.to_date(F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in DATE_FORMS]))


def _bound(value) -> datetime.date:
    text = str(value).strip()
    for form in ("%Y-%m-%d", "%m/%d/%Y"):
        try:
            return datetime.datetime.strptime(text, form).date()
        except ValueError:
            continue
    raise ValueError(f"{value!r} is not a date in YYYY-MM-DD or MM/DD/YYYY form.")


def _days_between(df: DataFrame, col, first: datetime.date, last: datetime.date) -> DataFrame:
    c = as_col(col)
    kind = df.select(c.alias("c")).schema["c"].dataType
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        # The bare column against literals: the scan can skip by it.
        return df.filter((c >= F.lit(first).cast(kind)) & (c < F.lit(last + datetime.timedelta(days=1)).cast(kind)))
    return df.filter(to_day(c).between(F.lit(first), F.lit(last)))


def modified_between(df: DataFrame, col, start=None, end=None) -> DataFrame:
    """Inclusive date range on ``col``; both bounds or neither, as
    YYYY-MM-DD or MM/DD/YYYY.  Text that is no date is outside any range."""
    if (start is None) != (end is None):
        raise ValueError("start and end must both be provided, or neither.")
    if start is None:
        return df
    return _days_between(df, col, _bound(start), _bound(end))


def rolling_window(df: DataFrame, col, as_of, days: int = 14) -> DataFrame:
    """The ``days`` days up to ``as_of`` (a parameter, never now())."""
    end = _bound(as_of)
    return _days_between(df, col, end - datetime.timedelta(days=days), end)


def layout_scope(df: DataFrame, layout: Layout | str, col: str = "digital_record") -> DataFrame:
    """Analog ("0") / digital carrier ("1") / storage (no filter).  A
    scoped layout needs the column (P5)."""
    layout = LAYOUTS[layout] if isinstance(layout, str) else layout
    if layout.digital_record is None:
        return df
    require_columns(df, [col])
    return df.filter(F.col(col).cast("string") == layout.digital_record)


# --------------------------------------------------------------------------
# V1-V5
# --------------------------------------------------------------------------

def _v(fieldname, message) -> Column:
    return F.struct(F.lit(fieldname).alias("field"),
                    (message if isinstance(message, Column) else F.lit(message)).alias("violation"))


def required_rules(df: DataFrame, layout: Layout) -> list[Column]:
    """V1: one conditional violation per present required field."""
    return [F.when(value_is_blank(df, f), _v(f, NULL_MESSAGE))
            for f in layout.required if f in df.columns]


def cross_rules(df: DataFrame, layout: Layout) -> list[Column]:
    """V4: conditional rules between fields (absent columns read as blank)."""
    t = lambda n: field_text(df, n)
    out: list[Column] = []
    if "tv_series" in layout.cross_rules:
        tv = F.upper(t("production_type")) == "TELEVISION SERIES"
        for ep in ("episode no.", "episode_title"):
            out.append(F.when(tv & (t(ep) == ""), _v(
                ep, f"{ep} is null but production_type is 'TELEVISION SERIES'.")))
    if "unknown_year" in layout.cross_rules:
        year = t("release_broadcast_year")
        cond = F.upper(year).isin("N/A", "UNKNOWN") & (t("record_date") == "")
        out.append(F.when(cond, _v("record_date", F.concat(
            F.lit("record_date is null but release_broadcast_year is "), py_repr(year), F.lit(".")))))
    if "temporary_retention" in layout.cross_rules:
        temp = F.upper(t("retention_status")) == "TEMPORARY"
        for d in ("retention_start_date", "retention_end_date"):
            out.append(F.when(temp & (t(d) == ""), _v(
                d, f"{d} is null but retention_status is 'Temporary'.")))
    if "sound_format" in layout.cross_rules:
        purpose = t("object_purpose")
        cond = F.upper(purpose).isin("PRESERVATION (FULL)", "ACCESS (CORE)") & (t("sound_format(1)") == "")
        out.append(F.when(cond, _v("sound_format(1)", F.concat(
            F.lit("sound_format(1) is null but object_purpose is "), py_repr(purpose), F.lit(".")))))
    return out


def child_rules(children: DataFrame, layout: Layout) -> list[Column]:
    """V3: per child row, required fields (absent column = blank) and dates."""
    out: list[Column] = []
    for f in layout.child_required:
        out.append(F.when(value_is_blank(children, f), _v(f, NULL_MESSAGE)))
        if f in layout.child_dates:
            v = field_text(children, f)
            out.append(F.when(~is_valid_date(v), _v(f, date_message(v))))
    return out


def _meta(df: DataFrame, layout: Layout) -> list[Column]:
    return [field_text(df, src).alias(dst) for dst, src in layout.meta.items()]


def violations(records: DataFrame, layout: Layout | str, children: DataFrame | str | None = None,
               parent_key: str | None = None, child_key: str | None = None,
               scoped: bool = True) -> DataFrame:
    """V5: V1 + V3 + V4 as long rows with the six report columns.

    ``children`` may be the name of an ``array<struct>`` column of
    ``records`` (exploded, not outer) or a DataFrame of child rows joined to
    the in-scope parents on ``parent_key == child_key``.
    """
    layout = LAYOUTS[layout] if isinstance(layout, str) else layout
    recs = layout_scope(records, layout) if scoped else records
    meta = _meta(recs, layout)
    flat_rules = required_rules(recs, layout) + cross_rules(recs, layout)
    out = _project(recs, meta, flat_rules)
    if layout.child_required and children is not None:
        if isinstance(children, str):
            kids = recs.select(*meta, F.explode(F.col(f"`{children}`")).alias("__c")).select(
                *[F.col(c) for c in layout.meta], "__c.*")
        else:
            # The rules need the child row only: they run first, without a
            # shuffle, and only violating rows meet their parents.
            parents = recs.select(F.col(f"`{parent_key}`").alias("__pk"), *meta)
            broken = _project(children, [F.col(f"`{child_key}`").alias("__ck")], child_rules(children, layout))
            found = broken.join(parents, F.col("__ck") == F.col("__pk"))
            return out.select(*REPORT_COLUMNS).unionByName(found.select(*REPORT_COLUMNS))
        kid_meta = [F.col(c) for c in layout.meta]
        out = out.unionByName(_project(kids, kid_meta, child_rules(kids, layout)))
    return out.select(*REPORT_COLUMNS)


def _project(df: DataFrame, keep: list[Column], rules: list[Column]) -> DataFrame:
    if not rules:
        empty = F.array().cast("array<struct<field:string,violation:string>>")
        return df.select(*keep, F.explode(empty).alias("__v")).select(
            *[c for c in df.select(*keep).columns], "__v.field", "__v.violation")
    arr = F.filter(F.array(*rules), lambda x: x.isNotNull())
    return df.select(*keep, F.explode(arr).alias("__v")).select(
        *[c for c in df.select(*keep).columns], "__v.field", "__v.violation")


def rule_name(violation: Column) -> Column:
    """The rule behind a message: messages that quote the bad value share one."""
    return (F.when(violation == NULL_MESSAGE, "required")
            .when(violation.startswith("Field value "), "date")
            .otherwise("cross field"))


def violation_totals(v: DataFrame, by=("layout", "field")) -> DataFrame:
    """A10: violation counts per group and rule (as many groups as rules, not
    as bad values)."""
    return v.groupBy(*by, rule_name(F.col("violation")).alias("rule")).agg(F.count(F.lit(1)).alias("violations"))


def records_checked(records: DataFrame, layout: Layout | str) -> DataFrame:
    """A10: number of records in scope for a layout."""
    layout = LAYOUTS[layout] if isinstance(layout, str) else layout
    recs = layout_scope(records, layout)
    return recs.agg(F.count(F.lit(1)).alias("records_checked")).select(
        F.lit(layout.name).alias("layout"), "records_checked")
