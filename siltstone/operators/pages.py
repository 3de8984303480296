"""Keyset pages: every page is found by the order key of the last row before it.

A page reads what lies at or behind its token, sorted and cut off, so page n costs what page 1 does; no offset is counted off. The
order is completed by the remaining columns. Rows that are equal in all of them cannot be told apart, so the token says how many
of them were given already. Tokens are text and can be kept.

A page for a screen is the top of what lies behind the token and goes through the driver. A larger one stays where the table is: its
last key is found from the sizes of a distributed sort, and its rows are those between two keys.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from siltstone.sources.scratch import scratch_path

UNORDERED = (T.MapType, T.VariantType)

#: Rows of the largest page that goes through the driver.
SCREEN = 1000


@dataclass(frozen=True)
class By:
    """One column of an order; NULLs come last unless said otherwise."""

    column: str
    descending: bool = False
    nulls_first: bool = False

    def sort(self) -> Column:
        kind = ("desc" if self.descending else "asc") + ("_nulls_first" if self.nulls_first else "_nulls_last")
        return getattr(F, kind)(F.col(f"`{self.column}`"))

    def behind(self, value: Column, absent: bool) -> Column:
        """Whether a row's value comes after the given one; ``absent``: that one is NULL."""
        cell = F.col(f"`{self.column}`")
        if absent:
            return cell.isNotNull() if self.nulls_first else F.lit(False)
        further = cell < value if self.descending else cell > value
        return F.coalesce(further, F.lit(False)) if self.nulls_first else further | cell.isNull()


def total_order(df: DataFrame, order: Sequence[By | str]) -> list[By]:
    """The order, completed by the other columns that have one."""
    given = [By(o) if isinstance(o, str) else o for o in order]
    named = {o.column for o in given}
    return given + [By(f.name) for f in df.schema.fields if f.name not in named and not isinstance(f.dataType, UNORDERED)]


def _spelled(df: DataFrame, column: str) -> Column:
    """A value as text that reads back as the same value."""
    kind = df.schema[column].dataType
    cell = F.col(f"`{column}`")
    if isinstance(kind, (T.ArrayType, T.StructType)):
        return F.when(cell.isNotNull(), F.to_json(F.struct(cell.alias("v")), {"ignoreNullFields": "false"}))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        cell = cell + F.lit(0).cast(kind)  # zero has no sign in an order
    return F.base64(cell) if isinstance(kind, T.BinaryType) else cell.cast("string")


def _read(df: DataFrame, column: str, text: str) -> Column:
    kind = df.schema[column].dataType
    if isinstance(kind, (T.ArrayType, T.StructType)):
        return F.from_json(F.lit(text), T.StructType([T.StructField("v", kind)]))["v"]
    return F.unbase64(F.lit(text)) if isinstance(kind, T.BinaryType) else F.lit(text).cast(kind)


def at_or_behind(df: DataFrame, order: Sequence[By], values: Sequence[str | None]) -> Column:
    """Rows that equal the given key or come after it. The first column alone bounds the scan."""
    first, condition = None, F.lit(True)
    for by, text in reversed(list(zip(order, values, strict=True))):
        value = F.lit(None) if text is None else _read(df, by.column, text)
        same = F.col(f"`{by.column}`").isNull() if text is None else F.col(f"`{by.column}`") == value
        first = by.behind(value, text is None) | same
        condition = by.behind(value, text is None) | (same & condition)
    return condition if first is None else first & condition


def equals(df: DataFrame, order: Sequence[By], values: Sequence[str | None]) -> Column:
    """Rows that equal the given key."""
    same = F.lit(True)
    for by, text in zip(order, values, strict=True):
        cell = F.col(f"`{by.column}`")
        same = same & (cell.isNull() if text is None else cell == _read(df, by.column, text))
    return F.coalesce(same, F.lit(False))


def _key_at(rows: DataFrame, order: Sequence[By], marks: Column, place: int) -> tuple[list[str | None], int] | None:
    """The key of the row at ``place`` (from 1), and how many rows up to there have it; None if no row comes behind it.

    Distinct keys are sorted by ranges and stored with their counts. The counts of the ranges tell the one that holds the
    place, and only that one is read again.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "page-keys")
    keys = rows.groupBy(*[F.col(f"`{o.column}`") for o in order]).agg(F.count(F.lit(1)).alias("_n")).orderBy(*[o.sort() for o in order])
    keys.withColumn("_part", F.spark_partition_id()).write.parquet(path)
    stored = spark.read.parquet(path)
    sizes = sorted(tuple(r) for r in stored.groupBy("_part").agg(F.sum("_n")).collect())
    if sum(n for _, n in sizes) <= place:
        return None
    before = 0
    for part, n in sizes:
        if before + n >= place:
            break
        before += n
    line = Window.partitionBy("_part").orderBy(*[o.sort() for o in order]).rowsBetween(Window.unboundedPreceding, 0)
    within = stored.where(F.col("_part") == part).select("_n", marks, F.sum("_n").over(line).alias("_upto"))
    found = within.where(F.col("_upto") >= place - before).orderBy("_upto").first()
    return list(found["_key"]), place - before - (found["_upto"] - found["_n"])


def _copies(df: DataFrame, rows: DataFrame, n: int, skip: int = 0) -> DataFrame:
    """``n`` of the rows that equal one key; where they have columns without an order, those behind the first ``skip``."""
    if any(isinstance(f.dataType, UNORDERED) for f in df.schema.fields):
        return rows.limit(n + skip).offset(skip)
    return df.sparkSession.range(n).select().crossJoin(F.broadcast(rows.limit(1)))


def _far_page(df: DataFrame, order: Sequence[By], marks: Column, n: int, held: dict | None) -> tuple[DataFrame, list[str | None] | None, int]:
    """A page of any size, the key of its last row, and how often that key was given so far."""
    again, rows, inside = 0, df, df
    if held is not None:
        again, rows = held["again"], df.where(at_or_behind(df, order, held["values"]))
        inside = rows.where(~equals(df, order, held["values"]))
    last = _key_at(rows, order, marks, again + n)
    parts = []
    if held is not None and (last is None or last[0] != held["values"]):
        opening = rows.where(equals(df, order, held["values"]))
        if (left := opening.count() - again) > 0:
            parts.append(_copies(df, opening, left, again))
    if last is None:
        parts.append(inside)
    else:
        skip = again if held is not None and last[0] == held["values"] else 0
        parts.append(inside.where(~F.coalesce(at_or_behind(df, order, last[0]), F.lit(False))))
        parts.append(_copies(df, rows.where(equals(df, order, last[0])), last[1] - skip, skip))
    page = parts[0]
    for part in parts[1:]:
        page = page.unionByName(part)
    return page.orderBy(*[o.sort() for o in order]), *(last or (None, 0))


def keyset_page(df: DataFrame, order: Sequence[By | str], n: int, token: str | None = None) -> tuple[DataFrame, str | None]:
    """The first ``n`` rows behind the token, in order, and the token of the next page (None behind the last row).

    A token fits the order, and a table with the same columns, that it was made for. Rows that were added before the token's place
    are not seen again; none is given twice or left out.
    """
    whole = total_order(df, order)
    again, rows, held = 0, df, None
    if token is not None:
        held = json.loads(token)
        if held["order"] != [[o.column, o.descending, o.nulls_first] for o in whole]:
            raise ValueError("the token belongs to another order")
        again = held["again"]
        rows = df.where(at_or_behind(df, whole, held["values"]))
    marks = F.array(*[_spelled(df, o.column) for o in whole]).alias("_key")
    named = [[o.column, o.descending, o.nulls_first] for o in whole]
    if n > SCREEN:
        page, values, same = _far_page(df, whole, marks, n, held)
        return page, None if values is None else json.dumps({"order": named, "values": values, "again": same}, ensure_ascii=False)
    found = rows.select("*", marks).orderBy(*[o.sort() for o in whole]).limit(n + again + 1).offset(again).collect()  # one page and a row
    page = df.sparkSession.createDataFrame([tuple(r)[:-1] for r in found[:n]], df.schema)
    if len(found) <= n:
        return page, None
    last = found[n - 1]["_key"]
    same = sum(r["_key"] == last for r in found[:n])
    if token is not None and same == n and last == held["values"]:
        same += again
    return page, json.dumps({"order": named, "values": list(last), "again": same}, ensure_ascii=False)
