"""Territory codes and taxonomy paths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from siltstone.functions.text import as_column
from siltstone.sources.scratch import scratch_root

# Level names of the territorial register, top down.
REGION, COUNTY, MUNICIPALITY = "wojewodztwo", "powiat", "gmina"


def _filled(value: Column) -> Column:
    return F.coalesce(value, F.lit("")) != ""


def territory_columns(region: str, county: str, municipality: str, kind: str) -> dict[str, Column]:
    """Padded code parts, level, composite code and parent code of a register row.

    The first blank part decides the level.
    """
    r, c, m = (F.lpad(F.col(n), 2, "0") for n in (region, county, municipality))
    has_county, has_municipality = _filled(F.col(county)), _filled(F.col(municipality))
    return {
        "woj": r,
        "pow": F.when(has_county, c),
        "gmi": F.when(has_municipality, m),
        "rodz": F.nullif(F.col(kind), F.lit("")),
        "level": F.when(~has_county, F.lit(REGION)).when(~has_municipality, F.lit(COUNTY)).otherwise(F.lit(MUNICIPALITY)),
        "teryt_code": F.when(~has_county, r)
        .when(~has_municipality, F.concat(r, c))
        .otherwise(F.concat(r, c, m, F.coalesce(F.col(kind), F.lit("")))),
        "parent_teryt_code": F.when(~has_county, F.lit(None)).when(~has_municipality, r).otherwise(F.concat(r, c)),
    }


def municipality_code(region: str, county: str, municipality: str, kind: str) -> Column:
    parts = [F.lpad(F.col(n), 2, "0") for n in (region, county, municipality)]
    return F.concat(*parts, F.coalesce(F.col(kind), F.lit("")))


def street_name(prefix: str, primary: str, secondary: str) -> Column:
    """Prefix, secondary part and primary name, blank parts left out."""
    parts = [F.nullif(F.col(c), F.lit("")) for c in (prefix, secondary)]
    return F.when(F.col(primary).isNotNull(), F.trim(F.concat_ws(" ", *parts, F.col(primary))))


def taxonomy_paths(
    nodes: DataFrame,
    *,
    id: str,
    parent: str,
    name: str,
    kind: str,
    area: str = "AREA",
    group: str = "GROUP",
    sep: str = " > ",
) -> DataFrame:
    """Every node with its path from the root, its area and its domain.

    The area is the nearest node of kind ``area`` on the path; the domain is the first ``group`` below the first area. Paths
    grow by pointer doubling: every node holds what lies between it and a node further up, and in a round joins that
    with what the upper node holds. So a tree of depth d takes log2(d) rounds, each one equi join whose result is checkpointed. A
    node whose parent is not there, or that hangs on a cycle, is an error, and so is an id that is there twice.
    """
    base = nodes.select(
        F.col(id).alias("node_id"), F.col(parent).alias("parent_id"), F.col(name).alias("node_name"), F.col(kind).alias("node_kind")
    )
    scratch_root(nodes.sparkSession)
    inside = F.col("node_kind") == area
    opens = ~inside & (F.col("node_kind") == group) & (F.coalesce("node_name", F.lit("")) != "")
    held = base.select(
        "*",
        F.col("parent_id").alias("_up"),
        F.col("node_name").alias("_path"),
        F.lit(1).alias("_levels"),
        F.when(inside, F.coalesce("node_name", F.lit(""))).alias("_area"),
        F.when(opens, F.col("node_name")).alias("_lead"),
        F.lit(None).cast("string").alias("_domain"),
    ).checkpoint()
    wrong = held.groupBy("node_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("node_id").limit(1).collect()
    if wrong:
        raise ValueError(f"node {wrong[0][0]!r} is there more than once")
    known = held.select(F.col("node_id").alias("_up"))
    orphan = held.where("_up is not null").join(known, "_up", "left_anti").select("node_id").limit(1).collect()
    if orphan:
        raise ValueError(f"the parent of node {orphan[0][0]!r} is missing")
    open_ = held.where("_up is not null").count()
    while open_:
        upper = held.select(F.col("node_id").alias("_up"), *[F.col(c).alias(f"u{c}") for c in ("_up", "_path", "_levels", "_area", "_lead", "_domain")])
        joined = held.join(upper.withColumnRenamed("u_up", "_next"), "_up", "left")
        met = F.col("u_levels").isNotNull()
        # a group directly below the upper part's area opens the domain, if none is open yet
        below = F.when(F.coalesce(F.col("u_area"), F.lit("")) != "", F.col("_lead"))
        held = joined.select(
            *base.columns,
            F.col("_next").alias("_up"),
            F.when(met, F.concat_ws(sep, "u_path", "_path")).otherwise(F.col("_path")).alias("_path"),
            (F.col("_levels") + F.coalesce("u_levels", F.lit(0))).alias("_levels"),
            F.coalesce("_area", "u_area").alias("_area"),
            F.when(met & (F.col("u_lead").isNotNull() | F.col("u_area").isNotNull()), F.col("u_lead")).otherwise(F.col("_lead")).alias("_lead"),
            F.coalesce("u_domain", below, "_domain").alias("_domain"),
        ).checkpoint()
        left = held.where("_up is not null").count()
        if left == open_:  # some nodes reach the root in every round, as long as any can
            raise ValueError(f"{left} nodes hang on a cycle")
        open_ = left
    return held.select(
        *base.columns,
        F.coalesce("_area", F.lit("")).alias("thematic_area"),
        F.coalesce("_domain", F.lit("")).alias("domain"),
        F.col("_path").alias("taxonomy_path"),
        F.col("_levels").alias("tree_level"),
    )


def area_rows_check(df: DataFrame, code: str, name: str, measures: Sequence[str]) -> DataFrame:
    """Normalised surface-area rows with the reason a row is unusable (``row_error``).

    Codes lose all white space and must be digits; measures must be whole numbers after
    truncation; rows with nothing in them are dropped.
    """
    cells = [F.col(c) for c in (code, name, *measures)]
    rows = df.where(F.coalesce(*[c.cast("string") for c in cells]).isNotNull())
    packed = F.regexp_replace(F.col(code).cast("string"), r"\s", "")
    numbers = {m: F.col(m).try_cast("double").try_cast("bigint") for m in measures}
    incomplete, broken = F.lit(False), F.lit(False)
    for cell in cells:
        incomplete = incomplete | cell.isNull()
    for value in numbers.values():
        broken = broken | value.isNull()
    error = (
        F.when(incomplete, F.lit("incomplete_row"))
        .when(~packed.rlike("^[0-9]+$"), F.lit("invalid_code"))
        .when(broken, F.lit("invalid_measure"))
    )
    return rows.select(
        F.rtrim(F.col(code).cast("string")).alias("code_source"),
        packed.alias("code"),
        F.col(name).cast("string").alias("unit_name"),
        *[v.alias(m) for m, v in numbers.items()],
        error.alias("row_error"),
    )


def require_no_errors(df: DataFrame, error: str = "row_error") -> DataFrame:
    """Fail the query at the first row that carries an error; drop the error column."""
    checked = df.where(F.assert_true(as_column(error).isNull(), F.concat(F.lit("bad row: "), as_column(error))).isNull())
    return checked.drop(error)
