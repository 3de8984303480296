"""Governed metrics: fixed column, fixed filter, fixed grain.

A metric is answered only at its declared grain, where one row exists per grain key; the
aggregate is an identity there, and ``grain_check`` proves it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, functions as F

from siltstone.functions.text import is_finite


@dataclass(frozen=True)
class Metric:
    name: str
    table: str
    column: str
    date_column: str
    dimensions: tuple[str, ...] = ()
    where: Mapping[str, object] = field(default_factory=dict)
    kind: str = "value"  # "value": finite and not negative; "count": not negative; "ratio": in [0, 1]
    latest_dates: int = 1

    @property
    def grain(self) -> tuple[str, ...]:
        return (self.date_column, *self.dimensions)


FX_GRAIN = ("currency_key", "source_table_key")


def _fx(name: str, column: str, table: str) -> Metric:
    return Metric(name, "fact_fx_quotes", column, "effective_date", FX_GRAIN, {"source_table_key": table}, latest_dates=2)


def _mart(prefix: str, table: str, columns: Sequence[str], renamed: Mapping[str, str] | None = None) -> list[Metric]:
    renamed = renamed or {}
    return [
        Metric(
            f"{prefix}_{renamed.get(c, c)}", table, c, "snapshot_date", kind="ratio" if c.endswith("_ratio") else "count"
        )
        for c in columns
    ]


# The governed metrics with their columns and grains.
METRICS: dict[str, Metric] = {
    m.name: m
    for m in [
        _fx("nbp_table_a_mid", "mid", "A"),
        _fx("nbp_table_b_mid", "mid", "B"),
        _fx("nbp_table_c_bid", "bid", "C"),
        _fx("nbp_table_c_ask", "ask", "C"),
        Metric(
            "nbp_gold_price_pln_per_gram_1000",
            "fact_gold_prices",
            "price_pln_per_gram_1000",
            "effective_date",
            ("commodity_key",),
            latest_dates=2,
        ),
        *_mart(
            "bdl",
            "mart_bdl_coverage",
            [
                "source_universe_total",
                "discovered_total",
                "landed_accepted_total",
                "modeled_total",
                "modeled_observation_total",
                "discovery_coverage_ratio",
                "modeled_coverage_ratio",
            ],
        ),
        *_mart(
            "eurostat",
            "mart_eurostat_coverage",
            [
                "admitted_dataset_total",
                "admitted_series_total",
                "modeled_dataset_total",
                "modeled_series_total",
                "modeled_response_total",
                "modeled_cell_total",
                "modeled_value_total",
                "admitted_dataset_coverage_ratio",
                "admitted_series_coverage_ratio",
                "catalogue_distributions",
                "validated_current_distributions",
                "full_distribution_coverage_ratio",
            ],
            {
                "catalogue_distributions": "catalogue_distribution_total",
                "validated_current_distributions": "validated_distribution_total",
            },
        ),
        *_mart(
            "wdi",
            "mart_wdi_coverage",
            [
                "current_archive_total",
                "archive_member_total",
                "source_geography_total",
                "source_indicator_total",
                "source_value_total",
                "modeled_geography_total",
                "modeled_indicator_total",
                "modeled_observation_total",
                "modeled_value_coverage_ratio",
            ],
        ),
    ]
}


def find_metric(name: str, registry: Mapping[str, Metric] = METRICS) -> Metric:
    if name not in registry:
        raise ValueError(f"unknown metric {name!r}; choose one of {', '.join(registry)}")
    return registry[name]


def _day(value: str | date) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


def _rows(metric: Metric, df: DataFrame) -> DataFrame:
    for column, value in metric.where.items():
        df = df.where(F.col(column) == F.lit(value))
    return df


def query_metric(
    metric: Metric, df: DataFrame, start: str | date, end: str | date, group_by: Sequence[str] | None = None
) -> DataFrame:
    """Metric values at the declared grain between two days, both included."""
    if group_by is not None and tuple(group_by) != metric.grain:
        raise ValueError(f"{metric.name} is defined only at the grain {', '.join(metric.grain)}")
    start, end = _day(start), _day(end)
    if end < start:
        raise ValueError("the end date lies before the start date")
    window = _rows(metric, df).where(F.col(metric.date_column).between(F.lit(start), F.lit(end)))
    return window.groupBy(*metric.grain).agg(F.max(metric.column).alias(metric.name))


def grain_check(metric: Metric, df: DataFrame, allowed: Mapping[str, Sequence[object]] | None = None) -> DataFrame:
    """Defects that would make the metric meaningless, as one row of counts.

    Keys must be filled, allowed codes kept, values sound for their kind, and the grain
    unique. One shuffle on the grain serves all counts.
    """
    rows = _rows(metric, df)
    value = F.col(metric.column)
    sound = value.isNotNull() & is_finite(value) & (value >= 0)
    if metric.kind == "ratio":
        sound = sound & (value <= 1)
    blank = F.lit(False)
    for column in metric.grain:
        blank = blank | F.col(column).isNull() | (F.col(column).cast("string") == "")
    strange = F.lit(False)
    for column, values in (allowed or {}).items():
        strange = strange | ~F.coalesce(F.col(column).isin(*values), F.lit(False))
    per_key = rows.groupBy(*metric.grain).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(blank).alias("_blank"),
        F.count_if(strange).alias("_strange"),
        F.count_if(~F.coalesce(sound, F.lit(False))).alias("_bad"),
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    is_date = dict(df.dtypes)[metric.date_column] == "date"
    return per_key.agg(
        total("_n").alias("row_count"),
        total("_blank").alias("blank_key_rows"),
        total("_strange").alias("unknown_code_rows"),
        total("_bad").alias("invalid_value_rows"),
        F.count_if(F.col("_n") > 1).alias("duplicate_grain_keys"),
    ).select("*", F.lit(is_date).alias("date_typed"))


def validate_grain(metric: Metric, df: DataFrame, allowed: Mapping[str, Sequence[object]] | None = None) -> None:
    """Raise if ``grain_check`` finds a defect."""
    found = grain_check(metric, df, allowed).first().asDict()
    defects = {k: v for k, v in found.items() if k not in ("row_count", "date_typed") and v}
    if not found["date_typed"]:
        defects["date_typed"] = False
    if defects:
        raise ValueError(f"{metric.name}: invalid grain {defects}")


def latest_dates_window(df: DataFrame, day: str, n: int) -> DataFrame:
    """Rows of the latest n distinct days (fewer if there are fewer)."""
    days = df.select(day).where(F.col(day).isNotNull()).distinct().orderBy(F.desc(day)).limit(n)
    return df.join(days, day, "left_semi")


def metric_crosscheck(metric: Metric, df: DataFrame) -> DataFrame:
    """Metric against its table over the latest days: differing rows on either side."""
    recent = latest_dates_window(_rows(metric, df), metric.date_column, metric.latest_dates)
    expected = recent.select(*metric.grain, F.col(metric.column).alias("value"))
    answered = recent.groupBy(*metric.grain).agg(F.max(metric.column).alias("value"))
    one = F.lit(1).cast("long")
    signed = expected.withColumn("_s", one).unionByName(answered.withColumn("_s", -one))
    return signed.groupBy(*metric.grain, "value").agg(F.sum("_s").alias("surplus")).where("surplus <> 0")
