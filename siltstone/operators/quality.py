"""Data quality, equivalence proofs and reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from siltstone.functions.text import DECIMAL_PATTERN


# --- equality of datasets ---------------------------------------------------------------


def _signed(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Net multiplicity per distinct row: positive on the left only, negative on the right only."""
    a = left.select(*columns, F.lit(1).cast("long").alias("_sign"))
    b = right.select(*columns, F.lit(-1).cast("long").alias("_sign"))
    return a.unionByName(b).groupBy(*columns).agg(F.sum("_sign").alias("_net"))


def business_columns(left: DataFrame, right: DataFrame, technical: Sequence[str] = ()) -> list[str]:
    """Columns to compare; both sides must have the same set of them."""
    skip = set(technical)
    a, b = [c for c in left.columns if c not in skip], {c for c in right.columns if c not in skip}
    if set(a) != b:
        raise ValueError(f"schemas differ: only left {sorted(set(a) - b)}, only right {sorted(b - set(a))}")
    return a


def dataset_equivalence(left: DataFrame, right: DataFrame, technical: Sequence[str] = ()) -> DataFrame:
    """Multiset comparison on the business columns, as one row of counts.

    Both one-sided differences come from a single signed count per distinct row, so the two
    datasets are shuffled once together, after map-side combining.
    """
    columns = business_columns(left, right, technical)
    net = _signed(left, right, columns).agg(
        F.coalesce(F.sum(F.greatest("_net", F.lit(0))), F.lit(0)).alias("only_left"),
        F.coalesce(F.sum(F.greatest(-F.col("_net"), F.lit(0))), F.lit(0)).alias("only_right"),
    )
    rows = left.agg(F.count(F.lit(1)).alias("n")), right.agg(F.count(F.lit(1)).alias("n"))
    return net.select(
        rows[0].scalar().alias("left_rows"),
        rows[1].scalar().alias("right_rows"),
        "only_left",
        "only_right",
        ((F.col("only_left") == 0) & (F.col("only_right") == 0)).alias("equivalent"),
    )


def dataset_differences(left: DataFrame, right: DataFrame, technical: Sequence[str] = ()) -> DataFrame:
    """The differing rows with their side and how many more of them that side has."""
    columns = business_columns(left, right, technical)
    return (
        _signed(left, right, columns)
        .where("_net <> 0")
        .select(
            *columns,
            F.when(F.col("_net") > 0, F.lit("left")).otherwise(F.lit("right")).alias("side"),
            F.abs("_net").alias("extra_rows"),
        )
    )


# --- keys -------------------------------------------------------------------------------


def exact_key_set(observed: DataFrame, expected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that break "exactly one row per expected key", with the reason."""
    have = observed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_have"), F.lit(0).cast("long").alias("_want"))
    want = expected.select(*keys).distinct().select(*keys, F.lit(0).cast("long").alias("_have"), F.lit(1).cast("long").alias("_want"))
    merged = have.unionByName(want).groupBy(*keys).agg(F.sum("_have").alias("row_count"), F.max("_want").alias("_want"))
    reason = (
        F.when(F.col("_want") == 0, F.lit("unexpected"))
        .when(F.col("row_count") == 0, F.lit("missing"))
        .when(F.col("row_count") > 1, F.lit("repeated"))
    )
    return merged.select(*keys, "row_count", reason.alias("reason")).where("reason is not null")


def missing_keys(baseline: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct baseline keys that the current data lacks (NULL members compare equal)."""
    return baseline.select(*keys).subtract(current.select(*keys))


def key_regression(
    baseline: DataFrame, current: DataFrame, keys: Sequence[str], day: str, sample: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Coverage of the baseline's keys up to the baseline's last day.

    Returns a one-row report and the missing keys in key order (the first ``sample`` of them
    if given).
    """
    cutoff = baseline.agg(F.max(day).alias("d"))
    reached = current.where(F.col(day) <= cutoff.scalar())
    old = baseline.select(*keys).distinct().withColumn("_old", F.lit(1))
    new = reached.select(*keys).distinct().withColumn("_new", F.lit(1))
    both = old.unionByName(new, allowMissingColumns=True).groupBy(*keys).agg(
        F.max("_old").alias("_old"), F.max("_new").alias("_new")
    )
    lost = both.where("_old = 1 and _new is null").select(*keys)
    report = both.agg(
        F.count("_old").alias("baseline_distinct_keys"),
        F.count("_new").alias("current_distinct_keys_through_cutoff"),
        F.count_if((F.col("_old") == 1) & F.col("_new").isNull()).alias("missing_key_count"),
    ).select(
        "*",
        cutoff.scalar().alias("baseline_max_date"),
        current.agg(F.max(day).alias("d")).scalar().alias("current_max_date"),
    )
    report = report.withColumn("max_date_regressed", F.col("current_max_date") < F.col("baseline_max_date"))
    ordered = lost.orderBy(*keys)
    return report, ordered if sample is None else ordered.limit(sample)


def duplicate_keys(df: DataFrame, keys: Sequence[str], only: Column | None = None) -> DataFrame:
    """Keys held by more than one row. ``only`` restricts the check to rows that decide it."""
    rows = df if only is None else df.where(only)
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def pending_inputs(inputs: DataFrame, represented: DataFrame, key: str, represented_key: str | None = None) -> DataFrame:
    """Inputs whose key (usually a content hash) is not represented yet."""
    done = represented.select(F.col(represented_key or key).alias(key)).distinct()
    return inputs.join(done, key, "left_anti")


def rows_with_keys(df: DataFrame, listed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are in a list; the list may repeat keys, and a key with a NULL is in no list."""
    return df.join(listed.select(*keys).distinct(), list(keys), "left_semi")


# --- reconciliation of values -----------------------------------------------------------


def value_reconciliation(
    requested: DataFrame,
    bulk: DataFrame,
    keys: Sequence[str],
    value: str,
    bulk_value: str,
    required: str | None = None,
) -> DataFrame:
    """Class of each requested value against the bulk data (``outcome``).

    A key with several bulk rows is reported as ambiguous and never resolved by picking one.
    Bulk rows nobody asks for are dropped first, by a semi join with the distinct requested
    keys; the rest is folded to one row per key before it meets the requests, so a key with
    very many bulk rows is combined where it lies. Values are compared as exact decimals of
    any length and exponent; a side that is no number is told before one that is not finite.
    """
    wanted = requested.select(*keys).distinct()
    index = bulk.join(wanted, list(keys), "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), F.min(bulk_value).alias("_bulk"))
    joined = requested.join(index, list(keys), "left").select("*", F.trim(F.col(value)).alias("_mine"), F.trim("_bulk").alias("_theirs"))
    mine, theirs = F.col("_mine"), F.col("_theirs")
    odd = "(?i)^[+-]?(nan|inf|infinity)$"
    key_text = F.col(required) if required else F.lit("x")
    # The names of the outcomes.
    outcome = (
        F.when(F.coalesce(key_text, F.lit("")) == "", F.lit(f"missing_{required}"))
        .when(
            F.col("_rows").isNull(),
            F.when(F.col(value).isNull(), F.lit("null_api_value_absent_from_bulk")).otherwise(F.lit("missing_bulk_key")),
        )
        .when(F.col("_rows") != 1, F.lit("ambiguous_bulk_key"))
        .when(F.col(value).isNull(), F.lit("null_api_value_with_bulk_key"))
        .when(F.col("_bulk").isNull(), F.lit("bulk_value_null"))
        .when(~(_parses(mine, odd) & _parses(theirs, odd)), F.lit("bulk_value_not_numeric"))
        .when(mine.rlike(odd) | theirs.rlike(odd), F.lit("nonfinite_value"))
        .when(mine == theirs, F.lit("exact_numeric_match"))  # spelled alike, as most are
        .when(exact_number(mine) == exact_number(theirs), F.lit("exact_numeric_match"))
        .otherwise(F.lit("value_conflict"))
    )
    return joined.select(*requested.columns, outcome.alias("outcome"))


def _parses(text: Column, odd: str) -> Column:
    return text.rlike(DECIMAL_PATTERN) | text.rlike(odd)


def exact_number(text: Column) -> Column:
    """Spelling that two number texts share exactly if they are equal: sign, digits without outer zeros, exponent."""
    mark = F.locate("e", F.lower(text))
    mantissa = F.when(mark > 0, F.substring(text, F.lit(1), mark - 1)).otherwise(text)
    exponent = F.when(mark > 0, F.substr(text, mark + 1))
    unsigned = F.ltrim(mantissa, F.lit("+-"))
    dot = F.locate(".", unsigned)
    fraction = F.when(dot > 0, F.length(unsigned) - dot).otherwise(F.lit(0))
    digits = F.ltrim(F.translate(unsigned, ".", ""), F.lit("0"))
    kept = F.rtrim(digits, F.lit("0"))
    power = F.coalesce(exponent.try_cast("decimal(30,0)"), F.lit(0)) - fraction + F.length(digits) - F.length(kept)
    spelled = F.concat(F.when(F.startswith(text, F.lit("-")), "-").otherwise(""), kept, F.lit("e"), power.cast("string"))
    return F.when(text.rlike(DECIMAL_PATTERN), F.when(kept == "", "0").otherwise(spelled))


def outcome_counts(df: DataFrame, by: Sequence[str] = (), outcome: str = "outcome") -> DataFrame:
    return df.groupBy(*by, outcome).agg(F.count(F.lit(1)).alias("row_count"))


# --- rules ------------------------------------------------------------------------------


def rule_violations(df: DataFrame, keys: Sequence[str], rules: Mapping[str, Column]) -> DataFrame:
    """One row per (record, broken rule). A rule is the condition of a violation; NULL is no violation."""
    broken = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in rules.items()]))
    return df.select(*keys, F.explode(broken).alias("rule"))


def repeated_in_group(df: DataFrame, group: Sequence[str], keys: Sequence[str], rule: str) -> DataFrame:
    """Uniqueness rule: the rows whose key repeats inside its group, one violation each.

    Members of the key that are NULL count as equal.
    """
    packed = df.withColumn("_group", F.struct(*group))
    repeated = duplicate_keys(packed, ["_group"]).select("_group")
    return packed.join(repeated, "_group", "left_semi").select(*keys, F.lit(rule).alias("rule"))


def page_checks(df: DataFrame, page: str, pages: str, per_page: str, total: str, rows: str) -> DataFrame:
    """Page arithmetic of paged responses; ``page_error`` is NULL for a sound page."""
    p, n, size, all_rows, got = (F.col(c) for c in (page, pages, per_page, total, rows))
    error = (
        F.when((p < 1) | (n < 0) | (size < 1) | (all_rows < 0), F.lit("invalid_number"))
        .when((n == 0) & (all_rows != 0), F.lit("rows_without_pages"))
        .when((n > 0) & (p > n), F.lit("page_beyond_last"))
        .when(got > size, F.lit("more_rows_than_page_size"))
        .when(got > all_rows, F.lit("more_rows_than_total"))
        .when((all_rows > 0) & (got == 0), F.lit("empty_page"))
    )
    return df.withColumn("page_error", error)


# --- profiles and partitions ------------------------------------------------------------


def dataset_profile(df: DataFrame, dataset: str, day: str | None = None) -> DataFrame:
    """Row count, date bounds and column list, as one row."""
    bounds = (
        [F.min(day).cast("date").cast("string").alias("min_date"), F.max(day).cast("date").cast("string").alias("max_date")]
        if day
        else [F.lit(None).cast("string").alias("min_date"), F.lit(None).cast("string").alias("max_date")]
    )
    columns = ",".join(f"{name}:{kind}" for name, kind in df.dtypes)
    return df.agg(F.count(F.lit(1)).alias("row_count"), *bounds).select(
        F.lit(dataset).alias("dataset_id"), "row_count", "min_date", "max_date", F.lit(columns).alias("column_types")
    )


def profile_differences(observed: DataFrame, recorded: DataFrame) -> DataFrame:
    """Fields in which an observed profile departs from the recorded contract."""
    names = ["row_count", "min_date", "max_date", "column_types"]
    left = observed.select("dataset_id", *[F.col(n).cast("string").alias(f"_o_{n}") for n in names])
    right = recorded.select("dataset_id", *[F.col(n).cast("string").alias(f"_r_{n}") for n in names])
    pairs = F.array(
        *[F.struct(F.lit(n).alias("field"), F.col(f"_r_{n}").alias("expected"), F.col(f"_o_{n}").alias("observed")) for n in names]
    )
    return (
        left.join(right, "dataset_id", "full_outer")
        .select("dataset_id", F.inline(pairs))
        .where(~F.col("expected").eqNullSafe(F.col("observed")))
    )


def partition_homogeneity(df: DataFrame, partition: Column, expected: Column, declared: DataFrame | None = None) -> DataFrame:
    """Per partition: rows, rows that carry another key than declared, and key bounds.

    ``declared`` (columns ``partition``, ``declared_rows``) adds the row-count comparison.
    """
    out = (
        df.select(partition.alias("partition"), expected.alias("_key"))
        .groupBy("partition")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(~F.col("_key").eqNullSafe(F.col("partition"))).alias("foreign_rows"),
            F.min("_key").alias("min_key"),
            F.max("_key").alias("max_key"),
        )
    )
    if declared is None:
        return out
    return out.join(declared, "partition", "full_outer").withColumn(
        "count_matches", F.col("row_count").eqNullSafe(F.col("declared_rows"))
    )
