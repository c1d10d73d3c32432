"""Anomaly rules over the dense table, their evaluation and triage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislecast.functions.ids import anomaly_id, stockout_id
from aislecast.functions.numeric import round_even
from aislecast.operators.curate import KEYS, SERIES
from aislecast.operators.features import rolling_mean, rolling_moments, rolling_std
from aislecast.operators.ordering import global_position
from aislecast.session import stage

WINDOW = 14
MIN_ROWS = 3


def with_demand_scores(curated: DataFrame, window: int = WINDOW, min_rows: int = MIN_ROWS) -> DataFrame:
    """Rolling mean, rolling deviation and z-score of the rows before.

    Too short a past takes the overall mean and a deviation of one; a past
    without any spread takes one as well.
    """
    overall = curated.agg(F.avg("qty_sold").alias("m")).scalar()
    deviation = rolling_std(window, min_rows)
    scored = rolling_moments(curated, [window]).select(
        *curated.columns,
        F.coalesce(rolling_mean(window, min_rows), overall).alias("rolling_mean"),
        F.when(deviation > 0, deviation).otherwise(1.0).alias("rolling_std"),
    )
    return scored.withColumn(
        "z_score", (F.col("qty_sold") - F.col("rolling_mean")) / F.col("rolling_std")
    )


def classify(
    shelf_limit: float = 2.0,
    spike_z: float = 3.0,
    spike_qty: int = 15,
    severe_z: float = 4.0,
    mismatch_qty: int = 20,
    mismatch_shelf: float = 35.0,
) -> Column:
    """The first rule that fits, as a struct; NULL if none does."""
    qty, shelf = F.col("qty_sold"), F.col("avg_shelf_qty")
    mean, z = F.col("rolling_mean"), F.col("z_score")

    def verdict(kind: str, severity: Column, score: Column, at: str, why: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("anomaly_type"),
            severity.alias("severity"),
            round_even(score, 2).alias("score"),
            F.lit(at).alias("at"),
            why.alias("description"),
        )

    stockout = verdict(
        "stockout_risk",
        F.when(shelf == 0.0, "high").otherwise("medium"),
        (F.lit(5.0) - shelf) / 5.0 + F.greatest(F.lit(0.0), mean / 5.0),
        "10:00:00",
        F.format_string(
            "Only %s units left on the shelf against an expected demand of %.1f. Restock.", shelf, round_even(mean, 1)
        ),
    )
    spike = verdict(
        "demand_spike",
        F.when(z >= severe_z, "high").otherwise("medium"),
        z,
        "14:30:00",
        F.format_string(
            "%s units sold, z-score %.2f over a rolling mean of %.1f.", qty, round_even(z, 2), round_even(mean, 1)
        ),
    )
    mismatch = verdict(
        "sensor_mismatch",
        F.lit("low"),
        qty / shelf,
        "18:00:00",
        F.format_string("Shelf reading stays at %s although %s units sold. Check the sensor.", shelf, qty),
    )
    return (
        F.when(shelf <= shelf_limit, stockout)
        .when((z >= spike_z) & (qty >= spike_qty), spike)
        .when((qty >= mismatch_qty) & (shelf >= mismatch_shelf), mismatch)
    )


def flag_anomalies(curated: DataFrame, **limits) -> DataFrame:
    """Anomalous days with type, severity, score and reason; no ids yet."""
    return (
        with_demand_scores(curated)
        .withColumn("_found", classify(**limits))
        .filter(F.col("_found").isNotNull())
        .select(
            *KEYS,
            F.concat_ws(" ", F.date_format("date", "yyyy-MM-dd"), "_found.at").alias("ts"),
            "_found.anomaly_type",
            "_found.severity",
            "_found.score",
            F.col("avg_shelf_qty").alias("shelf_qty"),
            "qty_sold",
            "_found.description",
            F.lit(False).alias("acknowledged"),
        )
    )


def detect_anomalies(curated: DataFrame, **limits) -> DataFrame:
    """Flagged days with ids that count on in (store, product, day) order.

    Numbering reads the flagged days several times, so they are stored first;
    the dense table is scored once.
    """
    flagged = stage(flag_anomalies(curated, **limits), "flagged-days")
    placed = global_position(flagged, out="_position")
    return placed.select(anomaly_id(F.col("_position")).alias("id"), *placed.columns[:-1])


def in_known_window(df: DataFrame, windows: DataFrame, out: str = "in_window") -> DataFrame:
    """Flag days that lie inside a known window of their series.

    Windows are unrolled to their days, which makes the range test an equality
    join with at most one match per row.
    """
    days = windows.select(
        *SERIES, F.explode(F.sequence("start_date", "end_date")).alias("date"), F.lit(True).alias(out)
    ).distinct()
    return df.join(days, KEYS, "left").withColumn(out, F.coalesce(out, F.lit(False)))


def _same_event(found: str = "a", known: str = "t") -> Column:
    a, t = (lambda c: F.col(f"{found}.{c}")), (lambda c: F.col(f"{known}.{c}"))
    return (
        (a("store_id") == t("store_id"))
        & (a("sku") == t("sku"))
        & (a("anomaly_type") == t("type"))
        & a("date").between(t("start_date"), t("end_date"))
    )


def scenario_coverage(anomalies: DataFrame, truth: DataFrame) -> DataFrame:
    """Detections per known scenario, scenarios without any included.

    Hits are counted first: an inner join may broadcast the scenarios if they
    are few, where an outer join from them would have to move all detections.
    """
    names = truth.columns
    hits = (
        anomalies.alias("a")
        .join(truth.distinct().alias("t"), _same_event())
        .groupBy(*[f"t.{c}" for c in names])
        .agg(F.count(F.lit(1)).alias("_hits"))
    )
    return (
        truth.join(hits, names, "left")
        .withColumn("detections", F.coalesce("_hits", F.lit(0)))
        .drop("_hits")
        .withColumn("found", F.col("detections") > 0)
    )


def scenario_recall(anomalies: DataFrame, truth: DataFrame) -> DataFrame:
    """Share of known scenarios with a detection; all of them if none is known."""
    return scenario_coverage(anomalies, truth).agg(
        F.count(F.lit(1)).alias("scenarios"),
        F.count_if("found").alias("found"),
        F.coalesce(
            F.try_divide(F.count_if("found") * 100.0, F.count(F.lit(1))), F.lit(100.0)
        ).alias("recall_pct"),
    )


def detection_precision(anomalies: DataFrame, truth: DataFrame) -> DataFrame:
    """Share of detections inside a known scenario, per type that is known."""
    known_types = truth.select(F.col("type").alias("anomaly_type")).distinct()
    scoped = anomalies.join(known_types, "anomaly_type", "left_semi")
    hits = (
        scoped.alias("a")
        .join(truth.alias("t"), _same_event(), "left_semi")
        .groupBy("anomaly_type")
        .agg(F.count(F.lit(1)).alias("true_detections"))
    )
    return (
        scoped.groupBy("anomaly_type")
        .agg(F.count(F.lit(1)).alias("detections"))
        .join(hits, "anomaly_type", "left")
        .withColumn("true_detections", F.coalesce("true_detections", F.lit(0)))
        .withColumn("precision_pct", F.col("true_detections") * 100.0 / F.col("detections"))
    )


def filter_anomalies(
    anomalies: DataFrame,
    status: str = "all",
    severity: str | None = None,
    anomaly_type: str | None = None,
    store_id: str | None = None,
    sku: str | None = None,
) -> DataFrame:
    """All the given conditions together; those not given do not filter."""
    states = {"open": ~F.col("acknowledged"), "acknowledged": F.col("acknowledged")}
    if status in states:
        anomalies = anomalies.filter(states[status])
    wanted = {
        "severity": severity and severity.lower(),
        "anomaly_type": anomaly_type and anomaly_type.lower(),
        "store_id": store_id,
        "sku": sku,
    }
    for column, value in wanted.items():
        if value:
            anomalies = anomalies.filter(F.col(column) == value)
    return anomalies


def anomaly_totals(anomalies: DataFrame) -> DataFrame:
    return anomalies.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~F.col("acknowledged")).alias("open_count"),
        F.count_if(F.col("acknowledged")).alias("acknowledged_count"),
    )


def list_anomalies(
    anomalies: DataFrame, limit: int = 100, **conditions
) -> tuple[DataFrame, DataFrame]:
    """Totals over everything, and one page of the matches in id order.

    Ids have at least four digits, so length before text gives their order.
    """
    if not 1 <= limit <= 1000:
        raise ValueError("limit must lie in 1..1000")
    page = (
        filter_anomalies(anomalies, **conditions).orderBy(F.length("id"), "id").limit(limit)
    )
    return anomaly_totals(anomalies), page


def anomaly_counts(anomalies: DataFrame) -> DataFrame:
    """Rows per type and per severity, in long form."""
    by = F.explode(
        F.array(
            F.struct(F.lit("anomaly_type").alias("field"), F.col("anomaly_type").alias("value")),
            F.struct(F.lit("severity").alias("field"), F.col("severity").alias("value")),
        )
    )
    return (
        anomalies.groupBy("anomaly_type", "severity")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(by.alias("_by"), "_n")
        .groupBy("_by.field", "_by.value")
        .agg(F.sum("_n").alias("rows"))
    )


def anomaly_stats(anomalies: DataFrame) -> DataFrame:
    """Totals and the two count maps in one row."""
    counts = anomaly_counts(anomalies)

    def as_map(field: str) -> Column:
        pairs = F.collect_list(F.when(F.col("field") == field, F.struct("value", "rows")))
        return F.map_from_entries(F.array_sort(pairs))

    maps = counts.agg(as_map("anomaly_type").alias("by_type"), as_map("severity").alias("by_severity"))
    return anomaly_totals(anomalies).select(
        "*", maps.select("by_type").scalar().alias("by_type"),
        maps.select("by_severity").scalar().alias("by_severity"),
    )


class UnknownAnomaly(KeyError):
    """An acknowledged id is not in the table."""


def with_acknowledgements(anomalies: DataFrame, acks: DataFrame) -> DataFrame:
    """Current state: the table plus a log of acknowledged ids."""
    done = acks.select(F.col("id"), F.lit(True).alias("_done")).distinct()
    state = F.col("acknowledged") | F.coalesce("_done", F.lit(False))
    return anomalies.join(done, "id", "left").withColumn("acknowledged", state).drop("_done")


def acknowledge(anomalies: DataFrame, acks: DataFrame) -> DataFrame:
    """As above, but an id that does not exist is an error."""
    stray = acks.join(anomalies, "id", "left_anti").select("id").first()
    if stray is not None:
        raise UnknownAnomaly(stray["id"])
    return with_acknowledgements(anomalies, acks)


def latest_known(df: DataFrame) -> DataFrame:
    """The newest value that is present, per series and column."""
    values = [c for c in df.columns if c not in SERIES]

    def newest(c: str) -> Column:
        return F.max_by(c, F.when(F.col(c).isNotNull(), F.col("date"))).alias(c)

    return df.groupBy(*SERIES).agg(*[newest(c) for c in values])


# The type names that mean a stockout, and those that exclude it.
STOCKOUT_TYPES = ("stockout", "stockout_risk")
OTHER_TYPES = ("demand_spike", "spike", "sensor_mismatch", "sensor_anomaly")


def active_stockouts(df: DataFrame) -> DataFrame:
    """Series whose latest known state is out of stock.

    ``anomaly_type`` and ``stock_level`` are optional columns.
    """
    for name, kind in (("anomaly_type", "string"), ("stock_level", "double"), ("avg_shelf_qty", "double")):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(kind))
    latest = latest_known(df.select(*KEYS, "anomaly_type", "stock_level", "avg_shelf_qty"))
    kind = F.coalesce(F.lower(F.trim("anomaly_type")), F.lit(""))
    level, shelf = F.col("stock_level"), F.col("avg_shelf_qty")
    empty = kind.isin(*STOCKOUT_TYPES) | (F.coalesce(level, shelf) <= 0)
    shown = F.when(shelf >= 0, shelf).otherwise(F.coalesce(level, F.lit(0.0)))
    return (
        latest.filter(~kind.isin(*OTHER_TYPES) & empty)
        .withColumn("shelf_qty", shown)
        .select(
            stockout_id(F.col("store_id"), F.col("sku"), F.col("date")).alias("id"),
            *KEYS,
            "shelf_qty",
            F.coalesce("stock_level", "shelf_qty").alias("stock_level"),
            F.format_string(
                "Shelf stock is down to %.1f units on the latest day (%s).",
                F.col("shelf_qty"),
                F.date_format("date", "yyyy-MM-dd"),
            ).alias("description"),
        )
    )
