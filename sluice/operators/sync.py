"""Incremental syncs: high-water marks, lead / unsubscribe payloads and their batches."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.text import delimited_list_cap, iso_format, list_cap_error
from .batching import batch_pack

# Payload batch sizes and the list attribute cap
LEAD_BATCH_SIZE = 75
UNSUBSCRIBE_BATCH_SIZE = 50
ARRAY_LIMIT = 25

# Lead payload keys (payload key -> lead column), in payload order
CUSTOM_ATTRS = [
    ("HubSpot Audience", "audience"),
    ("HubSpot Contact", "braze_hs_contact"),
    ("HubSpot Contact ID", "hs_object_id"),
    ("HubSpot Create Date", "createdate"),
    ("HubSpot - First Conversion", "first_conversion_event_name"),
    ("HubSpot - Lead Source", "lead_source_deal_value"),
    ("HubSpot - Lead Source Detail", "lead_source"),
    ("HubSpot Level of Education", "highest_level_of_education"),
    ("HubSpot Masters Interests", "masters_leads"),
    ("HubSpot Program Interests", "braze_programs"),
    ("HubSpot - utm_campaign", "utm_campaign"),
    ("HubSpot - utm_medium", "utm_medium"),
    ("HubSpot - utm_source", "utm_source"),
]
STANDARD_ATTRS = [
    ("country", "country_iso_code"),
    ("email", "email"),
    ("first_name", "firstname"),
    ("home_city", "city"),
    ("last_name", "lastname"),
    ("phone", "phone"),
]
ALIAS_LABEL = "hubspot"
UNSUBSCRIBED = "unsubscribed"
LIST_COLUMNS = {"masters_leads": "masters leads", "braze_programs": "program interests"}


def null_split(df: DataFrame, col: str = "lms_user_id") -> tuple[DataFrame, DataFrame]:
    """(unregistered: ``col IS NULL``, registered: ``col IS NOT NULL``)."""
    return df.where(F.col(col).isNull()), df.where(F.col(col).isNotNull())


def high_water_filter(df: DataFrame, col: str, mark=None, lookback: str | None = None) -> DataFrame:
    """Rows changed strictly after ``mark`` (no mark: all rows); pushed down to the scan.

    ``lookback`` (an interval such as ``'1 hour'``) re-reads a margin before the mark.
    """
    if mark is None:
        return df
    bound = F.lit(mark).cast(df.schema[col].dataType)
    if lookback:
        bound = bound - F.expr(f"interval {lookback}")
    return df.where(F.col(col) > bound)


def high_water_update(df: DataFrame, col: str, previous=None) -> DataFrame:
    """New mark = max(col) over the processed rows; the previous mark when there are none."""
    agg = df.agg(F.max(col).alias("mark"), F.count(F.lit(1)).alias("rows"))
    prev = F.lit(previous).cast(df.schema[col].dataType) if previous is not None else F.lit(None)
    return agg.select(F.coalesce("mark", prev).alias("mark"), iso_format(F.coalesce("mark", prev)).alias("mark_iso"),
                      "rows")


def processed_count(df: DataFrame, label: str, batch_size: int) -> DataFrame:
    """Rows and batches that a sync of ``df`` processes (one aggregate, partial + final)."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(label).alias("split"), "rows", F.ceil(F.col("rows") / batch_size).cast("long").alias("batches"))


def processed_counts(df: DataFrame, label: Column, batch_size: int) -> DataFrame:
    """``processed_count`` of every value of ``label`` in one pass."""
    return df.groupBy(label.alias("split")).agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "batches", F.ceil(F.col("rows") / batch_size).cast("long"))


def lead_custom_attrs(on_error: str = "column") -> Column:
    fields = []
    for key, col in CUSTOM_ATTRS:
        c = F.col(col)
        if col == "createdate":
            c = iso_format(c)
        elif col in LIST_COLUMNS:
            c = delimited_list_cap(col, ";", ARRAY_LIMIT, LIST_COLUMNS[col], F.col("hs_object_id"), on_error)
        fields.append(c.alias(key))
    return F.struct(*fields)


def lead_standard_attrs() -> Column:
    return F.struct(*[F.col(col).alias(key) for key, col in STANDARD_ATTRS])


def lead_errors() -> Column:
    errs = [list_cap_error(c, ";", ARRAY_LIMIT, label, F.col("hs_object_id")) for c, label in LIST_COLUMNS.items()]
    return F.filter(F.array(*errs), lambda e: e.isNotNull())


def lead_payload_struct(kind: str, on_error: str = "column") -> Column:
    custom = lead_custom_attrs(on_error)
    names = [k for k, _ in CUSTOM_ATTRS]
    if kind == "registered":
        return F.struct(F.col("lms_user_id").alias("external_id"), *[custom[n].alias(n) for n in names])
    if kind == "alias":
        std = lead_standard_attrs()
        return F.struct(
            F.lit(False).alias("_update_existing_only"),
            F.struct(F.lit(ALIAS_LABEL).alias("alias_label"), F.col("email").alias("alias_name")).alias("user_alias"),
            *[std[k].alias(k) for k, _ in STANDARD_ATTRS],
            *[custom[n].alias(n) for n in names],
        )
    raise ValueError("kind must be 'registered' or 'alias'")


def to_json_keep_nulls(c: Column) -> Column:
    return F.to_json(c, {"ignoreNullFields": "false"})


def lead_payload(df: DataFrame, kind: str, on_error: str = "column") -> DataFrame:
    """One JSON attribute object per lead (nulls kept), plus its list-cap errors."""
    return df.select("*", to_json_keep_nulls(lead_payload_struct(kind, on_error)).alias("payload"),
                     lead_errors().alias("errors"))


def lead_batches(df: DataFrame, kind: str, order_by: list[str], size: int = LEAD_BATCH_SIZE,
                 on_error: str = "raise") -> DataFrame:
    """Request bodies ``{"attributes": [...]}`` of at most ``size`` leads each: ``(batch_id, n, body, errors)``.

    A lead with a list over the cap fails the job, like the reference; with ``on_error="column"`` its list is null
    and ``errors`` of its batch says so."""
    objs = df.select(*order_by, F.struct(lead_payload_struct(kind, on_error).alias("attr"), lead_errors().alias("errs")).alias("lead"))
    packed = batch_pack(objs, size, order_by)
    return packed.select(
        "batch_id", "n",
        to_json_keep_nulls(F.struct(F.transform("rows", lambda r: r["lead"]["attr"]).alias("attributes"))).alias("body"),
        F.flatten(F.transform("rows", lambda r: r["lead"]["errs"])).alias("errors"))


def unsubscribe_payload(df: DataFrame, order_by: list[str], email_col: str = "email",
                        size: int = UNSUBSCRIBE_BATCH_SIZE) -> DataFrame:
    """Batches ``{"email": [...], "subscription_state": "unsubscribed"}`` of at most ``size`` emails."""
    packed = batch_pack(df.select(*order_by, F.col(email_col).alias("_email")), size, order_by)
    emails = F.transform("rows", lambda r: r["_email"])
    return packed.select("batch_id", "n", emails.alias("emails"), F.to_json(F.struct(
        emails.alias("email"), F.lit(UNSUBSCRIBED).alias("subscription_state"))).alias("payload"))


# --- state table of marks -------------------------------------------------------------

STATE_DDL = "key string, mark string"


def read_mark(spark: SparkSession, state_path: str, key: str):
    """The saved mark for ``key`` (one row of a tiny state table) or None."""
    from ..sinks.guard import read_target

    marks = read_target(spark, state_path)
    row = marks.where(F.col("key") == key).select("mark").first() if marks is not None else None
    return row["mark"] if row else None


def write_mark(spark: SparkSession, state_path: str, key: str, mark: str) -> None:
    """Save the mark of ``key``; marks of other keys stay, also those that another run saves at the same time."""
    from ..sinks.guard import stage_and_swap

    def marks(saved: DataFrame | None) -> DataFrame:
        new = spark.createDataFrame([(key, mark)], STATE_DDL)
        return (new if saved is None else saved.where(F.col("key") != key).unionByName(new)).coalesce(1)

    stage_and_swap(spark, marks, state_path)


def incremental_sync(spark: SparkSession, source: DataFrame, state_path: str, out_path: str, col: str,
                     key: str, payload=None, lookback: str | None = None) -> DataFrame:
    """Process rows above the saved mark, write their payload, then advance the mark.

    The mark advances only after the payload write committed, so a failed run
    is repeated (at least once). Output rows go to ``out_path/run=<id>``.
    Returns ``(run, rows, previous_mark, mark)``.
    """
    prev = read_mark(spark, state_path, key)
    todo = high_water_filter(source, col, prev, lookback)
    run = uuid.uuid4().hex[:12]
    obs = Observation(f"sync_{run}")
    # observed on the processed rows (the payload may batch them or drop the change column)
    observed = todo.observe(obs, F.count(F.lit(1)).alias("rows"), F.max(col).alias("mark"))
    shaped = payload(observed) if payload else observed
    shaped.write.mode("errorifexists").parquet(f"{out_path.rstrip('/')}/run={run}")
    stats = obs.get
    rows, mark = int(stats.get("rows", 0)), stats.get("mark")
    new_mark = prev
    if rows > 0 and mark is not None:
        new_mark = spark.range(1).select(iso_format(F.lit(mark).cast(source.schema[col].dataType)).alias("m")) \
                        .first()["m"]
        write_mark(spark, state_path, key, new_mark)
    return spark.createDataFrame([(run, rows, prev, new_mark)],
                                 "run string, rows bigint, previous_mark string, mark string")
