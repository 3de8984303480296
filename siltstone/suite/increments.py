"""Ledgers and events from stored state: the input comes in several increments, late and repeated."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from siltstone.operators.increments import EventState, RunState, VersionState
from siltstone.sources.scratch import scratch_path, stored_once
from siltstone.suite.ledgers import _events, _observed
from siltstone.suite.registry import ORACLES, query


def _increments(df: DataFrame, identity: list[str]) -> list[DataFrame]:
    """All rows in three increments without regard to time, so most rows are late, then two of them again."""
    third = F.pmod(F.xxhash64(*identity), F.lit(3))
    return [df.where(third == 1), df.where(third == 2), df.where(third != 1), df.where(third == 0)]


@query("incremental_run_ledger", ORACLES["revision_runs"])
def _runs(spark: SparkSession, folder: str) -> DataFrame:
    df = _events(spark, folder)
    state = RunState(
        spark, scratch_path(spark, "runs"), keys=["user_id"], order=["ts", "event_id"], state=["event_type"], chunk="day", seen_at="ts",
        payload=["value"], evidence={"event_id": "event_id"},
    )
    for part in _increments(df, ["event_id"]):
        state.apply(part)
    return state.ledger(df, events=[("observed_value_changed", "event_type")])


@query("incremental_version_ledger", ORACLES["revision_ledger"])
def _versions(spark: SparkSession, folder: str) -> DataFrame:
    df = _events(spark, folder).withColumn("k", F.get_json_object("props", "$.k").try_cast("int"))
    state = VersionState(
        spark, scratch_path(spark, "versions"), keys=["user_id"], fields=["user_id", "event_type", "k"], seen_at="ts", response=["event_id"],
        evidence={"event_id": "event_id"},
    )
    for part in _increments(df, ["event_id"]):
        state.apply(part)
    ledger = state.ledger(
        df,
        events=[("observed_value_changed", ["event_type"]), ("observed_representation_changed", ["k"])],
        order_by_text=True,
        chunk=F.date_trunc("day", "first_seen_at_utc"),
    )
    return ledger.drop("canonical_record_json", "canonical_record_sha256", "previous_record_sha256")


@query("incremental_change_events", ORACLES["change_events"])
def _changes(spark: SparkSession, folder: str) -> DataFrame:
    df = stored_once(_observed(spark, folder), "observed")  # every increment reads its part
    state = EventState(
        spark, scratch_path(spark, "events"), scope=["source", "day"], member="member", sequence="seq", values=["amount"], metadata=["label"],
        evidence=["evidence"], contract="typed_record_v1",
    )
    for part in _increments(df, ["source", "day", "seq"]):
        state.apply(part)
    return state.events(df).drop("previous_record_sha256", "current_record_sha256", "provider_event_asserted", "record_contract_version")
