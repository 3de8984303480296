"""Keyed selection, ledgers, change events and coverage intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from siltstone.operators.intervals import contiguous_through, coverage_gaps
from siltstone.operators.keyed import dedup_tiebreak, dedup_trimmed_key, first_last_by_order, latest_per_key
from siltstone.operators.ledger import (
    change_events,
    changed_fields,
    conflicting_keys,
    guarded_current,
    guarded_dedup,
    presence_timeline,
    revision_ledger,
    revision_runs,
)
from siltstone.operators.ordered import annotate_sequence
from siltstone.suite.registry import query, table


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").withColumn("day", F.col("ts").cast("date"))


@query(
    "latest_per_key",
    """
    select event_id, ts, user_id, event_type, value from events
    qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1
    """,
)
def _latest_per_key(spark, folder):
    df = table(spark, folder, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return latest_per_key(df, ["user_id", "event_type"], ["ts", "event_id"])


@query(
    "dedup_tiebreak",
    """
    select user_id, event_type, label, value, event_id from (
      select *, nullif(json_extract_string(props, '$.k'), '0') as label from events)
    qualify row_number() over (
      partition by user_id, event_type
      order by (label is not null) desc, label asc nulls last, value asc nulls last, event_id asc nulls last) = 1
    """,
)
def _dedup_tiebreak(spark, folder):
    label = F.nullif(F.get_json_object("props", "$.k"), F.lit("0"))
    df = table(spark, folder, "events").select("user_id", "event_type", label.alias("label"), "value", "event_id")
    return dedup_tiebreak(df, ["user_id", "event_type"], ["label"], ["value", "event_id"])


@query(
    "dedup_trimmed_key",
    """
    select trim(url) as url, page_id from (select case when html like '%lang="fr"%' then ' ' || url || '  ' else url end as url, page_id from pages)
    where nullif(trim(url), '') is not null
    qualify row_number() over (partition by trim(url) order by page_id) = 1
    """,
)
def _dedup_trimmed_key(spark, folder):
    padded = F.when(F.col("html").like('%lang="fr"%'), F.concat(F.lit(" "), "url", F.lit("  "))).otherwise(F.col("url"))
    df = table(spark, folder, "pages").select(padded.alias("url"), "page_id")
    return dedup_trimmed_key(df, "url", ["page_id"])


@query(
    "conflicting_keys",
    """
    select user_id, event_type, day from (
      select user_id, event_type, cast(ts as date) as day,
             try_cast(nullif(json_extract_string(props, '$.k'), '7') as integer) as k from events)
    group by all
    having count(distinct k) > 1 or (count(*) > count(k) and count(k) > 0)
    """,
)
def _conflicting_keys(spark, folder):
    k = F.nullif(F.get_json_object("props", "$.k"), F.lit("7")).try_cast("int")
    return conflicting_keys(_events(spark, folder).withColumn("k", k), ["user_id", "event_type", "day"], ["k"])


@query(
    "guarded_dedup",
    """
    select distinct p_partkey, p_brand, p_retailprice from lineitem join part on l_partkey = p_partkey
    """,
)
def _guarded_dedup(spark, folder):
    sold = table(spark, folder, "lineitem").join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return guarded_dedup(sold, identity=["p_partkey"], measures=["p_retailprice"], labels=["p_brand"])


@query(
    "guarded_current",
    """
    select user_id, day, event_id, value, event_type, ts, coalesce(value = 0, false) as has_zero from (
      select *, cast(ts as date) as day from events)
    qualify row_number() over (partition by user_id, day order by event_id desc, ts desc) = 1
    """,
)
def _guarded_current(spark, folder):
    return guarded_current(
        _events(spark, folder),
        source=[],
        identity=["user_id", "day"],
        sequence="event_id",
        measures=["value"],
        labels=["event_type"],
        evidence=["ts"],
        newest=["ts"],
        zero_flag="has_zero",
    )


@query(
    "first_last_by_order",
    """
    select user_id,
           arg_min(k, (ts, event_id)) as first_k, arg_max(k, (ts, event_id)) as last_k,
           arg_min(event_type, (ts, event_id)) as first_event_type, arg_max(event_type, (ts, event_id)) as last_event_type
    from (select *, try_cast(nullif(json_extract_string(props, '$.k'), '7') as integer) as k from events)
    group by user_id
    """,
)
def _first_last(spark, folder):
    k = F.nullif(F.get_json_object("props", "$.k"), F.lit("7")).try_cast("int")
    df = table(spark, folder, "events").withColumn("k", k)
    return first_last_by_order(df, ["user_id"], ["ts", "event_id"], ["k", "event_type"])


@query(
    "revision_runs",
    """
    with lined as (
      select *, lag(event_type) over w as before, row_number() over w as n from events
      window w as (partition by user_id order by ts, event_id)),
    numbered as (
      select *, sum(case when n > 1 and event_type is not distinct from before then 0 else 1 end)
                over (partition by user_id order by ts, event_id rows unbounded preceding) as run from lined),
    runs as (
      select user_id, run, min(event_type) as event_type, arg_min(value, (ts, event_id)) as value,
             min(ts) as first_seen_at_utc, max(ts) as last_seen_at_utc, count(*) as replayed_response_count,
             arg_min(event_id, (ts, event_id)) as first_event_id, arg_max(event_id, (ts, event_id)) as last_event_id
      from numbered group by user_id, run)
    select user_id, cast(run as bigint) as revision_number,
           cast(max(run) over (partition by user_id) as bigint) as revision_count,
           event_type, value, first_seen_at_utc, last_seen_at_utc, replayed_response_count, first_event_id, last_event_id,
           run = max(run) over (partition by user_id) as is_current,
           lag(event_type) over (partition by user_id order by run) as previous_event_type,
           case when run = 1 then 'first_observed' else 'observed_value_changed' end as revision_event_type
    from runs
    """,
)
def _revision_runs(spark, folder):
    df = _events(spark, folder)
    return revision_runs(
        df,
        keys=["user_id"],
        order=["ts", "event_id"],
        state=["event_type"],
        payload=["value"],
        seen_at="ts",
        evidence={"event_id": "event_id"},
        events=[("observed_value_changed", "event_type")],
        chunk=F.col("day"),
    )


@query(
    "revision_ledger",
    """
    with versions as (
      select user_id, event_type, try_cast(json_extract_string(props, '$.k') as integer) as k,
             min(ts) as first_seen_at_utc, max(ts) as last_seen_at_utc, count(*) as replayed_response_count,
             min(event_id) as first_event_id, max(event_id) as last_event_id
      from events group by all),
    lined as (
      select *, row_number() over w as revision_number, count(*) over (partition by user_id) as revision_count,
             row_number() over (partition by user_id order by last_seen_at_utc desc) = 1 as is_current,
             lag(event_type) over w as previous_event_type, lag(k) over w as previous_k, row_number() over w = 1 as is_first
      from versions window w as (partition by user_id order by first_seen_at_utc))
    select user_id, event_type, k, first_seen_at_utc, last_seen_at_utc, replayed_response_count, first_event_id, last_event_id,
           revision_number, revision_count, is_current, previous_event_type, previous_k,
           case when is_first then 'first_observed'
                when event_type is distinct from previous_event_type then 'observed_value_changed'
                when k is distinct from previous_k then 'observed_representation_changed'
                else 'observed_metadata_changed' end as revision_event_type
    from lined
    """,
)
def _revision_ledger(spark, folder):
    ledger = revision_ledger(
        table(spark, folder, "events"),
        keys=["user_id"],
        record={
            "user_id": "user_id",
            "event_type": "event_type",
            "k": F.get_json_object("props", "$.k").try_cast("int"),
        },
        seen_at="ts",
        evidence={"event_id": "event_id"},
        events=[("observed_value_changed", ["event_type"]), ("observed_representation_changed", ["k"])],
        order_by_text=True,
        chunk=F.date_trunc("day", "first_seen_at_utc"),
    )
    return ledger.drop("canonical_record_json", "canonical_record_sha256", "previous_record_sha256")


_OBSERVED = """
    observed as (
      select event_type as source, cast(ts as date) as day, user_id as member, cast(extract(hour from ts) as integer) as seq,
             sum(cast(value as decimal(18,2))) as amount, max(json_extract_string(props, '$.k')) as label,
             min(event_id) as evidence
      from events group by all),
    batches as (select source, day, seq, min(evidence) as evidence from observed group by all),
    members as (select source, day, member, min(seq) as first_seq from observed group by all),
    timeline as (
      select m.source, m.day, m.member, b.seq, b.evidence, o.amount, o.label, o.seq is not null as is_present
      from members m join batches b on m.source = b.source and m.day = b.day and b.seq >= m.first_seq
      left join observed o on o.source = m.source and o.day = m.day and o.member = m.member and o.seq = b.seq)
"""


def _observed(spark: SparkSession, folder: str) -> DataFrame:
    """Records of one source, publication day, member and response hour."""
    return (
        table(spark, folder, "events")
        .groupBy(
            F.col("event_type").alias("source"),
            F.col("ts").cast("date").alias("day"),
            F.col("user_id").alias("member"),
            F.hour("ts").alias("seq"),
        )
        .agg(
            F.sum(F.col("value").cast("decimal(18,2)")).alias("amount"),
            F.max(F.get_json_object("props", "$.k")).alias("label"),
            F.min("event_id").alias("evidence"),
        )
    )


@query(
    "presence_timeline",
    f"with {_OBSERVED} select source, day, member, seq, evidence, cast(amount as decimal(28,2)) as amount, label, is_present from timeline",
)
def _presence(spark, folder):
    return presence_timeline(
        _observed(spark, folder),
        scope=["source", "day"],
        member="member",
        sequence="seq",
        fields=["amount", "label"],
        evidence=["evidence"],
    )


@query(
    "change_events",
    f"""
    with {_OBSERVED},
    lined as (
      select *, lag(is_present) over w as p_present, lag(amount) over w as p_amount, lag(label) over w as p_label,
             lag(seq) over w as p_seq, lag(evidence) over w as p_evidence
      from timeline window w as (partition by source, day, member order by seq)),
    named as (
      select *, case when p_present is null then null
                     when p_present and not is_present then 'source_record_missing'
                     when not p_present and is_present then 'source_record_reappeared'
                     when is_present and p_present and amount is distinct from p_amount then 'source_value_changed'
                     when is_present and p_present and label is distinct from p_label then 'source_metadata_changed'
                end as event_type
      from lined)
    select source, day, member, event_type,
           cast(to_json(list_filter([case when is_present is distinct from p_present then 'record_presence' end,
                                     case when amount is distinct from p_amount then 'amount' end,
                                     case when label is distinct from p_label then 'label' end], lambda x: x is not null)) as varchar) as changed_fields,
           p_seq as previous_seq, seq, p_evidence as previous_evidence, evidence,
           cast(p_amount as decimal(28,2)) as previous_amount, cast(amount as decimal(28,2)) as current_amount,
           p_label as previous_label, label as current_label,
           case when event_type in ('source_record_missing', 'source_record_reappeared')
                then 'candidate_for_investigation' else 'observed_typed_record_change' end as evidence_status
    from named where event_type is not null
    """,
)
def _change_events(spark, folder):
    found = change_events(
        _observed(spark, folder),
        scope=["source", "day"],
        member="member",
        sequence="seq",
        values=["amount"],
        metadata=["label"],
        evidence=["evidence"],
        contract="typed_record_v1",
    )
    return found.drop(
        "previous_record_sha256", "current_record_sha256", "provider_event_asserted", "record_contract_version"
    )


@query(
    "changed_fields",
    """
    select event_id, cast(to_json(list_filter([
             case when event_type is distinct from lag(event_type) over w then 'event_type' end,
             case when value is distinct from lag(value) over w then 'value' end,
             case when props is distinct from lag(props) over w then 'props' end], lambda x: x is not null)) as varchar) as changed_fields
    from events window w as (partition by user_id order by ts, event_id)
    """,
)
def _changed_fields(spark, folder):
    names = ["event_type", "value", "props"]
    lined = annotate_sequence(
        _events(spark, folder), ["user_id"], ["ts", "event_id"], previous=names, chunk=F.col("day")
    )
    return lined.select(
        "event_id",
        changed_fields({n: F.col(n) for n in names}, {n: F.col(f"_prev.{n}") for n in names}).alias("changed_fields"),
    )


_SPANS = "select o_custkey, cast(o_orderdate as date) as lo, cast(o_orderdate as date) + 60 as hi from orders"


@query(
    "coverage_gaps",
    f"""
    with spans as ({_SPANS}),
    ends as (select o_custkey, lo, hi from spans where hi >= date '1995-06-01' and lo <= date '2001-01-31'
             union all select distinct o_custkey, date '2001-02-01', date '2001-01-31' from spans),
    lined as (select *, greatest(date '1995-05-31', coalesce(max(hi) over (
                partition by o_custkey order by lo, hi rows between unbounded preceding and 1 preceding), date '1995-05-31')) as reach from ends)
    select o_custkey, cast(reach + 1 as date) as gap_start, cast(least(lo - 1, date '2001-01-31') as date) as gap_end
    from lined where reach + 1 <= least(lo - 1, date '2001-01-31')
    """,
)
def _coverage_gaps(spark, folder):
    return coverage_gaps(_spans(spark, folder), ["o_custkey"], "lo", "hi", F.lit("1995-06-01").cast("date"), F.lit("2001-01-31").cast("date"))


@query(
    "contiguous_through",
    f"""
    with spans as ({_SPANS}),
    lined as (select *, greatest(date '1995-05-31', coalesce(max(hi) over (
                partition by o_custkey order by lo, hi rows between unbounded preceding and 1 preceding), date '1995-05-31')) as reach
              from spans where hi >= date '1995-06-01'),
    holes as (select o_custkey, min(lo) as hole from lined where lo > reach + 1 group by o_custkey)
    select c.o_custkey, max(s.hi) as contiguous_through
    from (select distinct o_custkey from spans) c
    left join holes h on h.o_custkey = c.o_custkey
    left join lined s on s.o_custkey = c.o_custkey and (h.hole is null or s.lo < h.hole)
    group by c.o_custkey
    """,
)
def _contiguous(spark, folder):
    return contiguous_through(_spans(spark, folder), ["o_custkey"], "lo", "hi", F.lit("1995-06-01").cast("date"))


def _spans(spark: SparkSession, folder: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return table(spark, folder, "orders").select("o_custkey", day.alias("lo"), F.date_add(day, 60).alias("hi"))
