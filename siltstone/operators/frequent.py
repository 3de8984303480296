"""Most frequent values from heavy-hitter summaries, exact.

Every task keeps a Misra-Gries summary of each column: at most ``capacity`` values, each counted too low by no more than the task's
error. Summaries add up; so do the errors. A value whose summed count plus the error stays below the k-th best count is not
among the best k, so few candidates are left, which a second pass counts exactly. Three cases need no second pass: a
column with no more values than the capacity, whose summary is its table of counts; a column stored in runs of equal values
(a clustered key), whose runs are counted where they lie; and a column without values. Only a column that is none of
these, and whose counts are too even for the error, has all its values shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from siltstone.sources.scratch import scratch_path

CAPACITY = 4096
#: Runs of ordered values that one task may consist of before its column counts as unordered.
SEGMENTS = 64

SUMMARY = "kind string, position int, value string, n long, lo string, hi string, lo_n long, hi_n long, runs long"


def _comparable(df: DataFrame, name: str) -> Column:
    """What a column is ordered by, as text that sorts alike: numbers and times become fixed-width hex."""
    kind = df.schema[name].dataType
    value = F.col(f"`{name}`")
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        if isinstance(kind, T.DateType):
            value = F.unix_date(value)
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            value = F.unix_micros(value.cast("timestamp"))
        return F.lpad(F.hex(value.cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    return value.cast("string")


class _Summary:
    """Misra-Gries counts and runs of one column in one task."""

    def __init__(self, capacity: int, k: int) -> None:
        self.capacity, self.k = capacity, k
        self.values, self.counts = pa.array([], pa.string()), np.zeros(0, np.int64)
        self.error, self.rows, self.nulls = 0, 0, 0
        self.segments: list[dict] = []
        self.ordered = True

    def add(self, value: pa.Array, order: pa.Array) -> None:
        self.rows += len(value)
        self.nulls += value.null_count
        if value.null_count:
            order, value = order.filter(value.is_valid()), value.drop_null()
        if not len(value):
            return
        counted = pc.value_counts(value)
        found = pa.table({"v": pa.concat_arrays([self.values, counted.field(0).cast(pa.string())]), "n": np.concatenate([self.counts, counted.field(1).to_numpy()])})
        found = found.group_by("v").aggregate([("n", "sum")])
        self._keep(found["v"].combine_chunks(), found["n_sum"].to_numpy())
        if self.ordered:
            self._run(value, order)

    def _keep(self, values: pa.Array, counts: np.ndarray) -> None:
        if len(counts) > self.capacity:
            cut = int(np.partition(counts, len(counts) - self.capacity - 1)[len(counts) - self.capacity - 1])
            self.error += cut  # no value loses more than this
            counts = counts - cut
            values, counts = values.filter(pa.array(counts > 0)), counts[counts > 0]
        self.values, self.counts = values, counts

    def _run(self, value: pa.Array, order: pa.Array) -> None:
        """Runs of equal values, in segments of ascending ones; first and last run of a segment may go on elsewhere."""
        change = np.concatenate([[True], pc.not_equal(order[1:], order[:-1]).to_numpy(zero_copy_only=False)])
        starts = np.flatnonzero(change)
        sizes = np.diff(np.append(starts, len(order)))
        heads, names = order.take(pa.array(starts)), value.take(pa.array(starts))
        falls = np.flatnonzero(pc.less(heads[1:], heads[:-1]).to_numpy(zero_copy_only=False)) + 1
        bounds = [0, *falls.tolist(), len(starts)]
        if len(self.segments) + len(falls) > SEGMENTS:
            self.ordered, self.segments = False, []
            return
        for lo, hi in zip(bounds, bounds[1:], strict=False):
            self._extend(heads[lo:hi], names[lo:hi], sizes[lo:hi])

    def _extend(self, heads: pa.Array, names: pa.Array, sizes: np.ndarray) -> None:
        first, last = heads[0].as_py(), heads[-1].as_py()
        s = self.segments[-1] if self.segments else None
        sizes = sizes.copy()
        if s is None or first < s["hi"]:
            s = {"lo": first, "hi": last, "runs": 0, "best": [], "open": (names[0].as_py(), 0), "first": None}
            self.segments.append(s)
        # the run that is open goes on, or ends here
        name, held = s["open"]
        if first == s["hi"] or s["runs"] == 0:
            sizes[0] += held
        else:
            self._close(s, [name], [held])
        s["runs"] += len(sizes) - (first == s["hi"] and s["runs"] > 0)
        if len(sizes) > 1:
            begun = s["first"] is None
            if begun:
                s["first"] = (names[0].as_py(), int(sizes[0]))
            ended = pa.table({"v": names[begun:-1], "n": sizes[begun:-1]})
            best = ended.take(pc.select_k_unstable(ended, self.k, [("n", "descending"), ("v", "ascending")]))
            self._close(s, best["v"].to_pylist(), best["n"].to_pylist())
        s["open"], s["hi"] = (names[-1].as_py(), int(sizes[-1])), last

    def _close(self, s: dict, names: list[str], sizes: list[int]) -> None:
        if s["first"] is None:
            s["first"] = (names[0], sizes[0])
            names, sizes = names[1:], sizes[1:]
        s["best"] = sorted([*s["best"], *zip(names, sizes, strict=True)], key=lambda x: (-x[1], x[0].encode()))[: self.k]

    def rows_of(self, position: int) -> Iterator[tuple]:
        yield ("total", position, None, self.rows, None, None, self.nulls, self.error, None)
        for v, n in zip(self.values.to_pylist(), self.counts.tolist(), strict=True):
            yield ("count", position, v, n, None, None, None, None, None)
        if not self.ordered:
            yield ("unordered", position, None, 1, None, None, None, None, None)
        for i, s in enumerate(self.segments):
            first, last = s["first"] or s["open"], s["open"]
            yield ("segment", position, None, i, s["lo"], s["hi"], first[1], last[1] if s["first"] else 0, s["runs"])
            yield ("border", position, first[0], first[1], s["lo"], None, None, None, None)
            if s["first"]:
                yield ("border", position, last[0], last[1], s["hi"], None, None, None, None)
            for v, n in s["best"]:
                yield ("run", position, v, n, None, None, None, None, None)


def summaries(df: DataFrame, columns: Sequence[str], k: int, capacity: int) -> DataFrame:
    """What the tasks say of each column (by its position), stored."""
    parts = [c for i, name in enumerate(columns) for c in (F.col(f"`{name}`").cast("string").alias(f"v{i}"), _comparable(df, name).alias(f"o{i}"))]
    width = len(columns)

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [_Summary(capacity, k) for _ in range(width)]
        for batch in batches:
            for i, s in enumerate(held):
                s.add(batch.column(2 * i), batch.column(2 * i + 1))
        rows = [r for i, s in enumerate(held) for r in s.rows_of(i)]
        names = ["kind", "position", "value", "n", "lo", "hi", "lo_n", "hi_n", "runs"]
        kinds = [pa.string(), pa.int32(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    path = scratch_path(df.sparkSession, "summaries")
    df.select(*parts).mapInArrow(tell, SUMMARY).write.parquet(path)
    return df.sparkSession.read.schema(SUMMARY).parquet(path)


def _best(counts: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each position by count, then value."""
    rank = F.row_number().over(Window.partitionBy("position").orderBy(F.desc("n"), F.asc("value")))
    return counts.withColumn("rank", rank).where(F.col("rank") <= k)


def _in_runs(told: DataFrame) -> DataFrame:
    """(position, distinct): columns whose segments do not overlap, so that equal values lie in one run or at touching borders.

    One short row for every segment of every task.
    """
    line = Window.partitionBy("position").orderBy("lo", "hi")
    segments = told.where("kind = 'segment'").select("position", "lo", "hi", "runs", F.lag("hi").over(line).alias("before"))
    one = segments.groupBy("position").agg(
        F.bool_and(F.coalesce(F.col("before") <= F.col("lo"), F.lit(True))).alias("apart"),
        (F.sum("runs") - F.count_if(F.col("before") == F.col("lo"))).alias("distinct"),
    )
    odd = told.where("kind = 'unordered'").select("position").distinct()
    return one.where("apart").select("position", "distinct").join(odd, "position", "left_anti")


def frequent_values(df: DataFrame, columns: Sequence[str], k: int, capacity: int = CAPACITY, distinct: bool = False) -> tuple[DataFrame, DataFrame, dict[str, list[int]]]:
    """Exact profiles of columns by position, as text values.

    Returns the best values (position, value, n, rank) with ties to the smaller value, the totals (position, rows, nulls, distinct),
    and how each column was decided: from its full ``summary``, its ``runs``, by ``counting`` candidates, or by a ``shuffle`` of all its
    values. ``distinct`` asks for the number of distinct values too, which candidates do not give; else it may be NULL.
    """
    spark = df.sparkSession
    told = summaries(df, columns, k, capacity)
    totals = told.where("kind = 'total'").groupBy("position").agg(F.sum("n").alias("rows"), F.sum("lo_n").alias("nulls"), F.sum("hi_n").alias("error"))
    counts = told.where("kind = 'count'").groupBy("position", "value").agg(F.sum("n").alias("n"))
    kth = _best(counts, k).groupBy("position").agg(F.min(F.when(F.col("rank") == k, F.col("n"))).alias("kth"), F.count(F.lit(1)).alias("listed"))
    states = totals.join(kth, "position", "left").join(_in_runs(told), "position", "left").collect()  # one row a column
    ways: dict[str, list[int]] = {"summary": [], "runs": [], "counting": [], "shuffle": []}
    for r in sorted(states, key=lambda r: r["position"]):
        if r["error"] == 0:
            way = "summary"
        elif r["distinct"] is not None:
            way = "runs"
        elif not distinct and r["kth"] is not None and r["kth"] > r["error"]:
            way = "counting"
        else:
            way = "shuffle"
        ways[way].append(r["position"])
    errors = {r["position"]: r["error"] for r in states}

    def of(rows: DataFrame, way: str) -> DataFrame:
        return rows.where(F.col("position").isin(ways[way]))

    exact = of(counts, "summary")
    # a run at a border may go on in the next segment; equal borders are added up
    borders = told.where("kind = 'border'").groupBy("position", "value").agg(F.sum("n").alias("n"))
    exact = exact.unionByName(of(borders.unionByName(told.where("kind = 'run'").select("position", "value", "n")), "runs"))

    def stacked(way: str) -> DataFrame:
        """(position, value) of the columns decided that way, without NULLs."""
        cells = [F.struct(F.lit(i).alias("position"), F.col(f"`{columns[i]}`").cast("string").alias("value")) for i in ways[way]]
        return df.select(F.inline(F.array(*cells))).where("value is not null")

    if ways["counting"]:
        bound = F.element_at(F.create_map(*[F.lit(x) for i in ways["counting"] for x in (i, errors[i])]), F.col("position"))
        likely = of(counts, "counting").join(kth, "position").where(F.col("n") + bound >= F.col("kth")).select("position", "value")
        few = likely.limit(100_001).count() <= 100_000
        counted = stacked("counting").join(F.broadcast(likely) if few else likely, ["position", "value"], "left_semi")
        exact = exact.unionByName(counted.groupBy("position", "value").agg(F.count(F.lit(1)).alias("n")))
    numbers = totals.select("position", "rows", "nulls").join(_in_runs(told), "position", "left")
    sizes = of(counts, "summary").groupBy("position").agg(F.count(F.lit(1)).alias("size"))
    if ways["shuffle"]:
        path = scratch_path(spark, "counts")
        stacked("shuffle").groupBy("position", "value").agg(F.count(F.lit(1)).alias("n")).write.parquet(path)
        shuffled = spark.read.schema("position int, value string, n long").parquet(path)
        exact = exact.unionByName(shuffled)
        sizes = sizes.unionByName(shuffled.groupBy("position").agg(F.count(F.lit(1)).alias("size")))
    empty = F.when(F.col("rows") == F.col("nulls"), F.lit(0).cast("long"))
    numbers = numbers.join(sizes, "position", "left").select("position", "rows", "nulls", F.coalesce("size", "distinct", empty).alias("distinct"))
    return _best(exact, k), numbers, ways
