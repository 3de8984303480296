"""Ledgers and events that grow with their input: stored state, merged with new responses only.

* ``VersionState`` keeps one row per version and increment; folding them is the ledger (``revision_ledger``).
* ``RunState`` keeps observations, and one piece per run inside a (record, chunk). A late observation rewrites the pieces of
  its chunk alone; runs that cross chunks are joined when the ledger is read.
* ``EventState`` keeps records and responses. A new response can change events of its publication from its own place in
  the sequence on; the sighting of every record before that place is all that is carried into the computation.

Each is exact for any split of the input into increments, in any order, and repeated input changes nothing: responses are
known by an identity, and those already applied are dropped before anything is folded. Reading gives the same rows as the operator
over all responses at once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from siltstone.operators.ledger import change_events, fold_replays, number_versions, run_pieces, runs_of_pieces
from siltstone.sources.store import EpochLog


def _ddl(df: DataFrame, columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)


def _equal(left: str, right: str, columns: Sequence[str]) -> Column:
    """NULL-safe equality of the same columns on two sides."""
    out = F.lit(True)
    for c in columns:
        out = out & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return out


def _without(rows: DataFrame, known: DataFrame, columns: Sequence[str], how: str = "left_anti") -> DataFrame:
    return rows.alias("l").join(known.select(*columns).distinct().alias("r"), _equal("l", "r", columns), how)


class VersionState:
    """Distinct versions of records over increments.

    ``response`` names the columns that identify a response (a content hash, say); a response that was applied before is dropped
    whole. The state has one row per version and increment that saw it: first and last sighting, number of replays, bounds of the
    evidence. ``compact`` folds them to one row per version.
    """

    def __init__(self, spark: SparkSession, folder: str, *, keys: Sequence[str], fields: Sequence[str], seen_at: str, response: Sequence[str], evidence: Mapping[str, str] | None = None) -> None:
        self.log = EpochLog(spark, folder)
        self.keys, self.fields, self.seen_at, self.response, self.evidence = list(keys), list(fields), seen_at, list(response), dict(evidence or {})
        self.bounds = [f"{side}_{s}" for s in self.evidence for side in ("first", "last")]

    def _schemas(self, sample: DataFrame) -> tuple[str, str]:
        kind = sample.schema[self.seen_at].dataType.simpleString()
        bounds = [f"`{side}_{s}` {sample.schema[c].dataType.simpleString()}" for s, c in self.evidence.items() for side in ("first", "last")]
        counted = [f"first_seen_at_utc {kind}", f"last_seen_at_utc {kind}", "replayed_response_count long", *bounds]
        return ", ".join([_ddl(sample, self.fields), *counted]), _ddl(sample, self.response)

    def apply(self, new: DataFrame) -> None:
        """Add responses. Only the new ones and the list of applied responses are read."""
        responses = self._schemas(new)[1]
        fresh = _without(new, self.log.read("responses", responses), self.response).persist()
        folded = fresh.groupBy(*self.fields).agg(
            F.min(self.seen_at).alias("first_seen_at_utc"),
            F.max(self.seen_at).alias("last_seen_at_utc"),
            F.count(F.lit(1)).alias("replayed_response_count"),
            *[f(c).alias(f"{side}_{s}") for s, c in self.evidence.items() for side, f in (("first", F.min), ("last", F.max))],
        )
        self.log.commit({"versions": folded.select(*self._columns()), "responses": fresh.select(*self.response).distinct()})
        fresh.unpersist()

    def _columns(self) -> list[str]:
        return [*self.fields, "first_seen_at_utc", "last_seen_at_utc", "replayed_response_count", *self.bounds]

    def versions(self, sample: DataFrame) -> DataFrame:
        """One row per version, folded over the increments."""
        return self.log.read("versions", self._schemas(sample)[0]).groupBy(*self.fields).agg(
            F.min("first_seen_at_utc").alias("first_seen_at_utc"),
            F.max("last_seen_at_utc").alias("last_seen_at_utc"),
            F.sum("replayed_response_count").alias("replayed_response_count"),
            *[(F.min if c.startswith("first") else F.max)(c).alias(c) for c in self.bounds],
        )

    def compact(self, sample: DataFrame) -> None:
        responses = self.log.read("responses", self._schemas(sample)[1]).drop("epoch")
        self.log.commit({"versions": self.versions(sample).select(*self._columns()), "responses": responses}, base=True)

    def ledger(self, sample: DataFrame, **options) -> DataFrame:
        """The revision ledger of everything applied; options as for ``number_versions``."""
        return number_versions(self.versions(sample), keys=self.keys, fields=self.fields, **options)


class RunState:
    """Runs of equal states over increments.

    An observation is identified by ``keys`` and ``order``; one that is applied again must say the same, or the increment
    fails. ``chunk`` (a column that never decreases along the order, such as the day) is the grain of the state: an increment reads
    the stored observations of the (record, chunk) pairs it touches and replaces their pieces.
    """

    def __init__(
        self, spark: SparkSession, folder: str, *, keys: Sequence[str], order: Sequence[str], state: Sequence[str], chunk: str, seen_at: str,
        payload: Sequence[str] = (), evidence: Mapping[str, str] | None = None,
    ) -> None:
        self.log = EpochLog(spark, folder)
        self.keys, self.order, self.state, self.chunk, self.seen_at = list(keys), list(order), list(state), chunk, seen_at
        self.payload, self.evidence = list(payload), dict(evidence or {})
        self.columns = list(dict.fromkeys([*keys, chunk, *order, *state, *payload, seen_at, *self.evidence.values()]))

    def _pieces(self, rows: DataFrame) -> DataFrame:
        return run_pieces(
            rows, keys=self.keys, order=self.order, state=self.state, payload=self.payload, seen_at=self.seen_at, evidence=self.evidence, chunk=self.chunk
        )

    def apply(self, new: DataFrame) -> None:
        """Add observations: new, late or repeated."""
        identity = [*self.keys, *self.order]
        others = [c for c in self.columns if c not in identity]
        schema = _ddl(new, self.columns)
        held = self.log.read("observations", schema).drop("epoch")
        touched = new.select(*self.keys, self.chunk).distinct()
        # the chunk prunes files: Parquet keeps its bounds, and epochs follow time
        bounds = touched.agg(F.min(self.chunk).alias("lo"), F.max(self.chunk).alias("hi")).first()
        near = held.where(F.col(self.chunk).between(F.lit(bounds["lo"]), F.lit(bounds["hi"])) | F.col(self.chunk).isNull())
        near = _without(near, touched, [*self.keys, self.chunk], "left_semi")
        both = near.unionByName(new.select(*self.columns))
        told = fold_replays(both, identity, others, agree_on=others, message="one observation with two contents").select(*self.columns).persist()
        fresh = _without(told, near, identity)
        self.log.commit({"observations": fresh.select(*self.columns), "pieces": self._pieces(told)})
        told.unpersist()

    def pieces(self, sample: DataFrame) -> DataFrame:
        """The latest pieces of every (record, chunk), in rows small beside the observations."""
        schema = self._pieces(sample.select(*self.columns).limit(0)).schema
        text = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        kept = self.log.read("pieces", text)
        group = [*self.keys, "_grain"]
        latest = kept.groupBy(*group).agg(F.max("epoch").alias("epoch"))
        return kept.alias("l").join(latest.alias("r"), _equal("l", "r", [*group, "epoch"]), "left_semi").drop("epoch")

    def compact(self, sample: DataFrame) -> None:
        observations = self.log.read("observations", _ddl(sample, self.columns)).drop("epoch")
        spread = observations.repartitionByRange(self.chunk).sortWithinPartitions(self.chunk)
        self.log.commit({"observations": spread, "pieces": self.pieces(sample)}, base=True)

    def ledger(self, sample: DataFrame, events: Sequence[tuple[str, str]], default_event: str = "observed_metadata_changed") -> DataFrame:
        """The run ledger of everything applied, from the pieces."""
        return runs_of_pieces(
            self.pieces(sample), keys=self.keys, state=self.state, payload=self.payload, evidence=list(self.evidence), events=events, default_event=default_event, chunk="_grain"
        )


class EventState:
    """Change events over increments.

    ``records`` hold one row per (scope, member, sequence). A response is a (scope, sequence) pair; all its records come in one increment, and
    a response that was applied before is dropped whole. For every touched publication the events from its first new response on are
    computed again, from the records since then and the last sighting of each record before; earlier events stay.
    """

    def __init__(self, spark: SparkSession, folder: str, *, scope: Sequence[str], member: str, sequence: str, **options) -> None:
        self.log = EpochLog(spark, folder)
        self.scope, self.member, self.sequence, self.options = list(scope), member, sequence, options

    def _events(self, records: DataFrame, responses: DataFrame | None = None) -> DataFrame:
        return change_events(records, scope=self.scope, member=self.member, sequence=self.sequence, responses=responses, **self.options)

    def apply(self, new: DataFrame) -> None:
        identity = [*self.scope, self.sequence]
        shown = [*self.options["evidence"], *self.options.get("from_response", ())]
        held = self.log.read("records", _ddl(new, new.columns)).drop("epoch")
        known = self.log.read("responses", _ddl(new, [*identity, *shown])).drop("epoch")
        fresh = _without(new, known, identity).persist()
        responses = fresh.groupBy(*identity).agg(*[F.min(c).alias(c) for c in shown])
        since = responses.groupBy(*self.scope).agg(F.min(self.sequence).alias("_since"))
        old = held.alias("l").join(since.alias("r"), _equal("l", "r", self.scope)).select("l.*", "r._since")
        later = old.where(F.col(self.sequence) >= F.col("_since")).drop("_since")
        # of what was seen before, only the last sighting of each record can still lead to an event
        rest = [c for c in new.columns if c not in (*self.scope, self.member)]
        before = old.where(F.col(self.sequence) < F.col("_since")).groupBy(*self.scope, self.member)
        carried = before.agg(F.max_by(F.struct(*rest), F.col(self.sequence)).alias("_row")).select(*self.scope, self.member, "_row.*").select(*new.columns)
        records = carried.unionByName(later).unionByName(fresh)
        steps = _without(known, since, self.scope, "left_semi").unionByName(responses)
        events = self._events(records, steps).alias("l").join(since.alias("r"), _equal("l", "r", self.scope))
        events = events.where(F.col(f"l.{self.sequence}") >= F.col("_since")).select("l.*")
        self.log.commit({"records": fresh, "responses": responses, "events": events, "touched": since})
        fresh.unpersist()

    def events(self, sample: DataFrame) -> DataFrame:
        """All events: of each publication, those that no later increment has computed again."""
        shape = self._events(sample.limit(0))
        kept = self.log.read("events", _ddl(shape, shape.columns))
        touched = self.log.read("touched", f"{_ddl(sample, self.scope)}, _since {sample.schema[self.sequence].dataType.simpleString()}")
        # one row per publication and increment: the first place that a later increment starts from
        line = Window.partitionBy(*self.scope).orderBy("epoch").rowsBetween(1, Window.unboundedFollowing)
        until = touched.select(*self.scope, "epoch", F.min("_since").over(line).alias("_until"))
        valid = kept.alias("l").join(until.alias("r"), _equal("l", "r", [*self.scope, "epoch"]))
        return valid.where(F.col("_until").isNull() | (F.col(f"l.{self.sequence}") < F.col("_until"))).select("l.*").drop("epoch")

    def compact(self, sample: DataFrame) -> None:
        shape = self._events(sample.limit(0))
        shown = [*self.options["evidence"], *self.options.get("from_response", ())]
        records = self.log.read("records", _ddl(sample, sample.columns)).drop("epoch")
        responses = self.log.read("responses", _ddl(sample, [*self.scope, self.sequence, *shown])).drop("epoch")
        since = responses.groupBy(*self.scope).agg(F.min(self.sequence).alias("_since"))
        self.log.commit({"records": records, "responses": responses, "events": self.events(sample).select(*shape.columns), "touched": since}, base=True)
