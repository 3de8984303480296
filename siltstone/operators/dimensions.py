"""Conformed dimensions and the joins that use them.

No join here forces a broadcast. Spark broadcasts a side only below
``spark.sql.autoBroadcastJoinThreshold`` (by statistics when planning, by measured shuffle
size when adaptive execution re-plans), and otherwise splits skewed partitions of the
fact side, so a growing dimension or a hot key changes the strategy and not the result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from siltstone.functions.dates import PERIOD_PATTERNS, calendar_columns, period_columns
from siltstone.functions.text import as_column
from siltstone.operators.keyed import latest_per_key


def period_dimension(
    df: DataFrame, key: str, also: Sequence[str] = (), granularities: Sequence[str] = tuple(PERIOD_PATTERNS)
) -> DataFrame:
    """One row per distinct period key with its granularity and calendar range."""
    periods = df.select(key, *also).distinct()
    return periods.select(
        F.col(key).alias("period_key"),
        *also,
        *[expr.alias(name) for name, expr in period_columns(key, granularities).items()],
    )


def date_spine(*roles: DataFrame) -> DataFrame:
    """Every day between the first and last date seen in any role (one date column each)."""
    bounds = None
    for role in roles:
        day = F.col(role.columns[0])
        part = role.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
        bounds = part if bounds is None else bounds.union(part)
    span = bounds.agg(F.min("lo").cast("date").alias("lo"), F.max("hi").cast("date").alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date_key"))
    return days.select("date_key", *[c.alias(n) for n, c in calendar_columns("date_key").items()])


def code_dimension(
    branches: Sequence[DataFrame], key: str, label: str, mandatory: str | None = None
) -> DataFrame:
    """Distinct codes over several sources with their smallest label, plus a mandatory member."""
    codes = None
    for branch in branches:
        part = branch.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(label).alias(label))
        codes = part if codes is None else codes.unionByName(part)
    if mandatory is not None:
        spark = branches[0].sparkSession
        extra = spark.range(1).select(
            F.lit(mandatory).alias(key), F.lit(None).cast("string").alias(label)
        )
        codes = codes.unionByName(extra)
    return codes.groupBy(key).agg(F.min(label).alias(label))


def inferred_members(
    known: DataFrame, facts: DataFrame, key: str, fact_key: str, placeholder: Mapping[str, Column]
) -> DataFrame:
    """Known members plus one placeholder row per key that only the facts carry.

    ``placeholder`` gives columns computed per missing key (aggregates allowed); the other
    columns of ``known`` are NULL.
    """
    missing = (
        facts.where(F.col(fact_key).isNotNull())
        .groupBy(F.col(fact_key).alias(key))
        .agg(*[expr.alias(name) for name, expr in placeholder.items()] or [F.count(F.lit(1)).alias("_n")])
        .join(known.select(key), key, "left_anti")
    )
    shaped = missing.select(
        *[
            F.col(f.name).cast(f.dataType).alias(f.name)
            if f.name in missing.columns
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in known.schema.fields
        ]
    )
    return known.unionByName(shaped)


def attribute_pivot(
    df: DataFrame, keys: Sequence[str], picks: Mapping[str, tuple[str, Column | None]], extra: Mapping[str, Column] | None = None
) -> DataFrame:
    """Spread attribute rows over columns: ``picks`` maps output -> (column, condition).

    The smallest non-NULL value among the rows that meet the condition is taken.
    """
    spread = [
        F.min(F.col(column) if condition is None else F.when(condition, F.col(column))).alias(name)
        for name, (column, condition) in picks.items()
    ]
    return df.groupBy(*keys).agg(*spread, *[c.alias(n) for n, c in (extra or {}).items()])


def bilingual_current(
    df: DataFrame,
    entity: Sequence[str],
    variant: Sequence[str],
    newest: Sequence[str],
    picks: Mapping[str, tuple[str, Column | None]],
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Latest row per (entity, language, kind), merged to one row per entity."""
    return attribute_pivot(latest_per_key(df, [*entity, *variant], newest), entity, picks, extra)


def label_join(df: DataFrame, labels: DataFrame, key: str, label_key: str, columns: Sequence[str]) -> DataFrame:
    """Left join labels whose key is text to a fact whose key may be a number."""
    picked = labels.select(F.col(label_key).alias("_label_key"), *columns)
    return df.join(picked, F.col(key).cast("string") == F.col("_label_key"), "left").drop("_label_key")


def fact_with_dimensions(
    fact: DataFrame, dimensions: Sequence[tuple[DataFrame, Mapping[str, str], Sequence[str]]], how: str = "left"
) -> DataFrame:
    """Join dimensions to a fact. Each entry is (dimension, {fact key: dimension key}, columns)."""
    out = fact
    for number, (dimension, keys, columns) in enumerate(dimensions):
        right = dimension.select(
            *[F.col(d).alias(f"_d{number}_{i}") for i, d in enumerate(keys.values())], *columns
        )
        matched = None
        for i, name in enumerate(keys):
            test = F.col(name) == F.col(f"_d{number}_{i}")
            matched = test if matched is None else matched & test
        out = out.join(right, matched, how).drop(*[f"_d{number}_{i}" for i in range(len(keys))])
    return out


def rollup_dimension(
    df: DataFrame,
    key: str,
    *,
    label: str | None = None,
    newest: str | None = None,
    distinct: Mapping[str, str] | None = None,
    counts: Mapping[str, Column | None] | None = None,
    bounds: Mapping[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """One row per member with its newest label, distinct counts, conditional counts and bounds.

    ``bounds`` maps output -> ("min" | "max", column).
    """
    aggregates = []
    if label is not None:
        known = F.when(F.col(label).isNotNull(), F.col(newest)) if newest else F.col(label)
        aggregates.append(F.max_by(label, known).alias(label))
    aggregates += [F.count_distinct(c).alias(n) for n, c in (distinct or {}).items()]
    aggregates += [
        (F.count(F.lit(1)) if test is None else F.count_if(test)).alias(n) for n, test in (counts or {}).items()
    ]
    aggregates += [(F.min if how == "min" else F.max)(c).alias(n) for n, (how, c) in (bounds or {}).items()]
    return df.groupBy(key).agg(*aggregates)


def child_count_dimension(entities: DataFrame, children: DataFrame, key: str, child: str, name: str) -> DataFrame:
    """Entities with the number of their distinct children; identical entity rows fold to one."""
    counted = children.groupBy(key).agg(F.count_distinct(child).alias(name))
    return (
        entities.distinct()
        .join(counted, key, "left")
        .withColumn(name, F.coalesce(F.col(name), F.lit(0).cast("long")))
    )


def hierarchy_names(
    df: DataFrame, level: str, name: str, parents: Sequence[tuple[str, Sequence[str], str]]
) -> DataFrame:
    """Resolve the names of a row's ancestors inside one register.

    Each entry is (level value, code columns that identify the ancestor, output column).
    """
    out = df
    for value, codes, output in parents:
        ancestor = df.where(F.col(level) == value).select(*codes, F.col(name).alias(output))
        out = out.join(ancestor, list(codes), "left")
    return out.select(*df.columns, *[output for _, _, output in parents])


def role_parents(
    entities: DataFrame, relations: DataFrame, key: str, child: str, parent: str, roles: Mapping[str, Column]
) -> DataFrame:
    """Join one relation several times, each time under another condition.

    Conditions filter the relation before its join. An entity with several matching
    relations keeps one row per relation.
    """
    out = entities
    for output, condition in roles.items():
        role = relations.where(condition).select(F.col(child).alias("_child"), F.col(parent).alias(output))
        out = out.join(role, F.col(key) == F.col("_child"), "left").drop("_child")
    return out


def union_levels(branches: Mapping[str, DataFrame], level: str = "level", order: Sequence[str] | None = None) -> DataFrame:
    """Stack aligned branches and tag each with its level; columns a branch lacks are NULL."""
    out = None
    for value, branch in branches.items():
        tagged = branch.withColumn(level, F.lit(value))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out if order is None else out.select(*order)


def attach_evidence(df: DataFrame, evidence: DataFrame, columns: Mapping[str, Column | str]) -> DataFrame:
    """Put values of a one-row evidence frame on every row.

    Scalar subqueries carry them: no join, and the query fails if the evidence has more
    than one row.
    """
    shaped = evidence.select(*[as_column(c).alias(n) for n, c in columns.items()])
    return df.select("*", *[shaped.select(n).scalar().alias(n) for n in columns])
