"""Revision ledgers, change events and guarded current values.

Three ledgers answer three questions about a re-observed record:

* ``revision_ledger`` - which distinct versions of the record exist (a version that comes
  back is the same version);
* ``revision_runs`` - which states did it go through (A, B, A is three states);
* ``change_events`` - what changed from one response to the next, including records that
  went missing and came back.

Identical replays are folded by partial aggregation before any ordering happens, and the
ordered steps accept a ``chunk`` column for keys that stay large after that.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from siltstone.functions.records import canonical_json, differs, record_hash
from siltstone.functions.text import any_zero, as_column
from siltstone.operators.keyed import latest_per_key
from siltstone.operators.ordered import annotate_sequence, number_runs
from siltstone.sources.scratch import stored_once


# --- conflicts and current values -------------------------------------------------------


def _disagreement(measures: Sequence[str], null_is_value: bool) -> Column:
    """Aggregate: do the rows of a group disagree on any measure?"""
    disagree = F.lit(False)
    for name in measures:
        spread = F.coalesce(F.min(name) != F.max(name), F.lit(False))
        if null_is_value:
            spread = spread | ((F.count(name) > 0) & (F.count(name) < F.count(F.lit(1))))
        disagree = disagree | spread
    return disagree


def conflicting_keys(
    df: DataFrame, keys: Sequence[str], measures: Sequence[str], null_is_value: bool = True
) -> DataFrame:
    """Keys whose rows disagree on a measure.

    Two distinct values disagree; with ``null_is_value`` a NULL beside a value disagrees
    too. Comparing min with max gives the same answer as counting distinct values and
    combines before the shuffle.
    """
    marked = df.groupBy(*keys).agg(_disagreement(measures, null_is_value).alias("_conflict"))
    return marked.where("_conflict").drop("_conflict")


def fold_replays(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], agree_on: Sequence[str] = (), message: str = ""
) -> DataFrame:
    """One row per key with the smallest non-NULL value of each column.

    ``agree_on`` names measures that must not disagree inside a key: the check rides on the
    same aggregation and fails the query when the rows are read.
    """
    conflict = _disagreement(agree_on, null_is_value=False).alias("_conflict")
    folded = df.groupBy(*keys).agg(*[F.min(c).alias(c) for c in columns], *([conflict] if agree_on else []))
    if not agree_on:
        return folded
    return folded.where(F.assert_true(~F.col("_conflict"), message or "conflicting source values").isNull()).drop("_conflict")


def guarded_current(
    df: DataFrame,
    *,
    source: Sequence[str],
    identity: Sequence[str],
    sequence: str,
    measures: Sequence[str],
    labels: Sequence[str] = (),
    evidence: Sequence[str] = (),
    newest: Sequence[str] = (),
    zero_flag: str | None = None,
    message: str = "conflicting values for one observation in one ingestion sequence",
) -> DataFrame:
    """Current value per identity, refusing input that contradicts itself.

    Rows of one source, identity and ingestion sequence are one observation: they may
    repeat, they may differ in labels, they must agree on the measures. The current value
    is the one of the highest sequence, ties broken by ``newest``.
    """
    # the sequence leads: the fold sorts by its keys, and a key that all rows share decides no comparison
    observed = fold_replays(
        df, [sequence, *source, *identity], [*measures, *labels, *evidence], agree_on=measures, message=message
    ).select(*source, *identity, sequence, *measures, *labels, *evidence)
    current = latest_per_key(observed, identity, [sequence, *newest])
    return current if zero_flag is None else current.withColumn(zero_flag, any_zero(*measures))


def guarded_dedup(
    df: DataFrame,
    *,
    identity: Sequence[str],
    measures: Sequence[str],
    labels: Sequence[str] = (),
    null_is_value: bool = True,
    message: str = "conflicting values for one key",
) -> DataFrame:
    """One row per key for input without an ingestion sequence; measures must agree.

    With ``null_is_value`` a NULL measure beside a filled one is a conflict as well.

    Filled labels win over missing ones, then the smallest label, then the smallest measure.
    Guard and choice are one aggregation: the smallest struct of (is NULL, value) pairs is the
    row a sort with NULLs last would put first.
    """
    ranked = F.min(F.struct(*[x for c in (*labels, *measures) for x in (F.col(c).isNull().alias(f"_no_{c}"), F.col(c))]))
    picked = df.groupBy(*identity).agg(_disagreement(measures, null_is_value).alias("_conflict"), ranked.alias("_row"))
    sound = picked.where(F.assert_true(~F.col("_conflict"), message).isNull())
    return sound.select(*identity, *[F.col(f"_row.{c}").alias(c) for c in (*labels, *measures)])


# --- version ledger ---------------------------------------------------------------------


def revision_ledger(
    df: DataFrame,
    *,
    keys: Sequence[str],
    record: Mapping[str, Column | str],
    seen_at: str,
    evidence: Mapping[str, str] | None = None,
    events: Sequence[tuple[str, Sequence[str]]],
    default_event: str = "observed_metadata_changed",
    look_back: Sequence[str] = (),
    hash_column: str = "canonical_record_sha256",
    order_by_text: bool = False,
    chunk: Column | str | None = None,
) -> DataFrame:
    """One row per distinct version of each record.

    ``record`` names the fields of the canonical record (name -> column), the ``keys`` among
    them; versions are equal when their canonical JSON is. Versions are numbered by first sighting; the current one
    is the one seen last. ``events`` lists (label, fields): the first entry with a changed
    field classifies the version. ``evidence`` maps output suffixes to columns of which the
    smallest and largest value are kept. ``look_back`` adds fields whose previous value is
    wanted though it decides no event. ``order_by_text`` breaks ties by the record text
    and not by its hash.
    """
    fields = list(record)
    kept = dict(evidence or {})
    shaped = df.select(
        *[as_column(expr).alias(name) for name, expr in record.items()],
        F.col(seen_at).alias("_seen"),
        *[F.col(c).alias(f"_ev_{s}") for s, c in kept.items()],
    )
    # Equal fields are equal JSON: rows are folded by their fields, and the text is written
    # once per version instead of once per row.
    versions = shaped.groupBy(*fields).agg(
        F.min("_seen").alias("first_seen_at_utc"),
        F.max("_seen").alias("last_seen_at_utc"),
        F.count(F.lit(1)).alias("replayed_response_count"),
        *[F.min(f"_ev_{s}").alias(f"first_{s}") for s in kept],
        *[F.max(f"_ev_{s}").alias(f"last_{s}") for s in kept],
    )
    return number_versions(
        versions, keys=keys, fields=fields, events=events, default_event=default_event, look_back=look_back, hash_column=hash_column, order_by_text=order_by_text, chunk=chunk
    )


def number_versions(
    versions: DataFrame,
    *,
    keys: Sequence[str],
    fields: Sequence[str],
    events: Sequence[tuple[str, Sequence[str]]],
    default_event: str = "observed_metadata_changed",
    look_back: Sequence[str] = (),
    hash_column: str = "canonical_record_sha256",
    order_by_text: bool = False,
    chunk: Column | str | None = None,
) -> DataFrame:
    """The ledger of folded versions: one row per distinct ``fields`` with its first and last sighting."""
    versions = versions.withColumn("canonical_record_json", canonical_json(fields)).withColumn(hash_column, record_hash("canonical_record_json"))
    tie = "canonical_record_json" if order_by_text else hash_column
    looked_at = list(dict.fromkeys([hash_column, *[f for _, group in events for f in group], *look_back]))
    lined = annotate_sequence(
        versions,
        keys,
        ["first_seen_at_utc", tie],
        previous=looked_at,
        newest=["last_seen_at_utc", tie],
        chunk=chunk,
    )
    kind = F.when(F.col("_prev").isNull(), F.lit("first_observed"))
    for label, group in events:
        changed = F.lit(False)
        for name in group:
            changed = changed | differs(name, f"_prev.{name}")
        kind = kind.when(changed, F.lit(label))
    return lined.select(
        *versions.columns,
        F.col("_row").alias("revision_number"),
        F.col("_rows").alias("revision_count"),
        F.struct("last_seen_at_utc", tie).eqNullSafe(F.col("_newest")).alias("is_current"),
        kind.otherwise(F.lit(default_event)).alias("revision_event_type"),
        F.col(f"_prev.{hash_column}").alias("previous_record_sha256"),
        *[F.col(f"_prev.{c}").alias(f"previous_{c}") for c in looked_at if c != hash_column],
    )


# --- run ledger -------------------------------------------------------------------------


def revision_runs(
    df: DataFrame,
    *,
    keys: Sequence[str],
    order: Sequence[str],
    state: Sequence[str],
    payload: Sequence[str] = (),
    seen_at: str,
    evidence: Mapping[str, str] | None = None,
    events: Sequence[tuple[str, str]],
    default_event: str = "observed_metadata_changed",
    chunk: Column | str | None = None,
) -> DataFrame:
    """One row per run of equal consecutive states, so a state that returns is a new revision.

    ``payload`` keeps the first known value in the run, ``evidence`` (suffix -> column) the
    first and last by the order. ``events`` lists (label, state column); the first changed
    column classifies the run.
    """
    pieces = run_pieces(df, keys=keys, order=order, state=state, payload=payload, seen_at=seen_at, evidence=evidence, chunk=chunk)
    if chunk is not None:  # the pieces and the sums over chunks both read them
        pieces = stored_once(pieces, "run-pieces")
    return runs_of_pieces(
        pieces, keys=keys, state=state, payload=payload, evidence=list(evidence or {}), events=events, default_event=default_event, chunk=None if chunk is None else "_grain"
    )


def _opening(name: str, position: Column) -> Column:
    """Aggregate: the first known value by position."""
    return F.min_by(F.col(name), F.when(F.col(name).isNotNull(), position)).alias(name)


def run_pieces(
    df: DataFrame,
    *,
    keys: Sequence[str],
    order: Sequence[str],
    state: Sequence[str],
    payload: Sequence[str] = (),
    seen_at: str,
    evidence: Mapping[str, str] | None = None,
    chunk: Column | str | None = None,
) -> DataFrame:
    """Runs of equal states inside each (key, ``_grain``), with the place ``_at`` where each begins.

    Without a chunk these are the runs themselves. The rows are shuffled once; what follows works on pieces.
    """
    rows = df.select("*", (F.lit(0) if chunk is None else as_column(chunk)).alias("_grain"))
    numbered = number_runs(rows, [*keys, "_grain"], order, state)
    position = F.struct(*order)
    return numbered.groupBy(*keys, "_grain", F.col("_run").alias("_piece")).agg(
        F.min(position).alias("_at"),
        *[_opening(c, position) for c in [*state, *payload]],
        F.min(seen_at).alias("first_seen_at_utc"),
        F.max(seen_at).alias("last_seen_at_utc"),
        F.count(F.lit(1)).alias("replayed_response_count"),
        *[F.min_by(c, position).alias(f"first_{s}") for s, c in (evidence or {}).items()],
        *[F.max_by(c, position).alias(f"last_{s}") for s, c in (evidence or {}).items()],
    )


def runs_of_pieces(
    pieces: DataFrame,
    *,
    keys: Sequence[str],
    state: Sequence[str],
    payload: Sequence[str] = (),
    evidence: Sequence[str] = (),
    events: Sequence[tuple[str, str]],
    default_event: str = "observed_metadata_changed",
    chunk: str | None = None,
) -> DataFrame:
    """The run ledger of pieces in the order of ``_at``: equal states on both sides of a chunk's border are one run."""
    numbered = number_runs(pieces, keys, ["_at"], state, chunk=chunk)
    position = F.col("_at")
    runs = numbered.groupBy(*keys, F.col("_run").alias("revision_number")).agg(
        F.max("_runs").alias("revision_count"),
        *[_opening(c, position) for c in [*state, *payload]],
        F.min("first_seen_at_utc").alias("first_seen_at_utc"),
        F.max("last_seen_at_utc").alias("last_seen_at_utc"),
        F.sum("replayed_response_count").alias("replayed_response_count"),
        *[F.min_by(f"first_{s}", position).alias(f"first_{s}") for s in evidence],
        *[F.max_by(f"last_{s}", position).alias(f"last_{s}") for s in evidence],
        F.min_by("_prev", position).alias("_before"),
    )
    kind = F.when(F.col("revision_number") == 1, F.lit("first_observed"))
    for label, name in events:
        kind = kind.when(differs(name, f"_before.{name}"), F.lit(label))
    return runs.select(
        *[c for c in runs.columns if c != "_before"],
        (F.col("revision_number") == F.col("revision_count")).alias("is_current"),
        *[F.col(f"_before.{c}").alias(f"previous_{c}") for c in state],
        kind.otherwise(F.lit(default_event)).alias("revision_event_type"),
    )


# --- presence and change events ---------------------------------------------------------


def _responses(records: DataFrame, scope: Sequence[str], sequence: str, evidence: Sequence[str]) -> DataFrame:
    """One row per response that still carries the publication, numbered, with its neighbours."""
    line = Window.partitionBy(*scope).orderBy(sequence)
    packed = F.struct(sequence, *evidence)
    return (
        records.groupBy(*scope, sequence)
        .agg(*[F.min(c).alias(c) for c in evidence])
        .select(
            *scope,
            F.col(sequence).alias("_seq"),
            packed.alias("_this"),
            F.lag(packed).over(line).alias("_earlier"),
            F.lead(packed).over(line).alias("_later"),
            F.row_number().over(line).alias("_step"),
        )
    )


def _sightings(placed: DataFrame, keys: Sequence[str], previous: Sequence[str], chunk_steps: int | None) -> DataFrame:
    """The sightings of each record in order, every one with the one before it.

    Steps are numbered per publication, so ``chunk_steps`` bounds what one task orders.
    """
    chunk = None if chunk_steps is None else F.floor(F.col("_step") / chunk_steps)
    return annotate_sequence(placed, keys, ["_step"], previous=previous, chunk=chunk)


def presence_timeline(
    records: DataFrame,
    *,
    scope: Sequence[str],
    member: str,
    sequence: str,
    fields: Sequence[str],
    evidence: Sequence[str],
    from_response: Sequence[str] = (),
    chunk_steps: int | None = None,
) -> DataFrame:
    """Each record at every response of its publication from its first sighting on.

    ``records`` holds one row per (scope, member, sequence). Absent steps are filled from
    the gap between one sighting and the next, so no record is paired with responses it
    does not need. ``from_response`` names fields that fall back to the response's value,
    ``chunk_steps`` splits records with very many sightings (see ``change_events``).
    """
    steps = _responses(records, scope, sequence, [*evidence, *from_response])
    last = Window.partitionBy(*scope)
    steps = steps.withColumn("_steps", F.max("_step").over(last))
    placed = records.withColumnRenamed(sequence, "_seq").join(steps.select(*scope, "_seq", "_step", "_steps"), [*scope, "_seq"])
    lined = _sightings(placed, [*scope, member], ["_step"], chunk_steps)
    since = F.coalesce(F.col("_prev._step") + 1, F.col("_step"))
    until = F.when(F.col("_row") == F.col("_rows"), F.col("_steps")).otherwise(F.col("_step"))
    spread = lined.select(
        *scope,
        member,
        F.col("_step").alias("_sighted"),
        F.struct(*fields).alias("_kept"),
        F.explode(F.sequence(since, until)).alias("_step"),
    )
    present = F.col("_step") == F.col("_sighted")
    return spread.join(steps.select(*scope, "_step", "_this"), [*scope, "_step"]).select(
        *scope,
        member,
        F.col(f"_this.{sequence}").alias(sequence),
        *[F.col(f"_this.{c}").alias(c) for c in evidence],
        *[
            F.coalesce(F.when(present, F.col(f"_kept.{c}")), F.col(f"_this.{c}")).alias(c)
            if c in from_response
            else F.when(present, F.col(f"_kept.{c}")).alias(c)
            for c in fields
        ],
        present.alias("is_present"),
    )


def changed_fields(now: Mapping[str, Column], before: Mapping[str, Column]) -> Column:
    """JSON array of the names whose values differ, in the given order."""
    names = [F.when(~now[name].eqNullSafe(before[name]), F.lit(name)) for name in now]
    return F.to_json(F.array_compact(F.array(*names)))


def change_events(
    records: DataFrame,
    *,
    scope: Sequence[str],
    member: str,
    sequence: str,
    values: Sequence[str],
    metadata: Sequence[str],
    evidence: Sequence[str],
    from_response: Sequence[str] = (),
    contract: str,
    record: Sequence[str] | None = None,
    labels: Mapping[str, str] | None = None,
    chunk_steps: int | None = None,
    responses: DataFrame | None = None,
) -> DataFrame:
    """Value changes, metadata changes, disappearances and returns between responses.

    Only responses that still carry the publication (``scope``) are compared; a response
    without it proves nothing about its members. A record has at most one row per retained
    response of its publication; where that is still too many for one task, ``chunk_steps``
    orders the sightings in chunks of so many responses. Every event follows from two consecutive
    sightings of a record and the responses next to them: no timeline of absent steps is
    built. ``responses`` (scope, sequence, evidence and ``from_response``) lists the responses where the records at hand do not
    show all of them. ``records`` holds one row per (scope, member, sequence). ``record`` gives the
    field order of the hashed canonical record.
    """
    names = {
        "missing": "source_record_missing",
        "returned": "source_record_reappeared",
        "value": "source_value_changed",
        "metadata": "source_metadata_changed",
        **(labels or {}),
    }
    fields = [*values, *metadata]
    ordered = record or [*scope, member, *fields]
    text = canonical_json([F.lit(contract).alias("record_contract_version"), *ordered])
    hashed = records.withColumn("_sha", record_hash(text))
    steps = _responses(hashed if responses is None else responses, scope, sequence, [*evidence, *from_response])
    placed = hashed.select(*scope, member, F.col(sequence).alias("_seq"), F.struct(*fields, "_sha").alias("_rec")).join(
        steps, [*scope, "_seq"]
    )
    lined = _sightings(placed, [*scope, member], ["_step", "_rec", "_this", "_later"], chunk_steps)

    def absent(at: str) -> dict[str, Column]:
        nothing = {f: F.lit(None).cast(hashed.schema[f].dataType) for f in fields}
        return {**nothing, **{f: F.col(f"{at}.{f}") for f in from_response}}

    def held(at: str, response: str) -> dict[str, Column]:
        kept = {f: F.col(f"{at}.{f}") for f in fields}
        return {**kept, **{f: F.coalesce(kept[f], F.col(f"{response}.{f}")) for f in from_response}}

    no_hash = F.lit(None).cast("string")

    def event(kind: Column, now: dict, before: dict, shown: Column, gone: Column, at: str, prior: str, sha: Column, sha_before: Column) -> Column:
        fields_now = {"record_presence": shown, **now}
        fields_before = {"record_presence": gone, **before}
        return F.struct(
            kind.alias("event_type"),
            changed_fields(fields_now, fields_before).alias("changed_fields"),
            F.col(f"{prior}.{sequence}").alias(f"previous_{sequence}"),
            F.col(f"{at}.{sequence}").alias(sequence),
            *[F.col(f"{prior}.{c}").alias(f"previous_{c}") for c in evidence],
            *[F.col(f"{at}.{c}").alias(c) for c in evidence],
            sha_before.alias("previous_record_sha256"),
            sha.alias("current_record_sha256"),
            *[before[c].alias(f"previous_{c}") for c in fields],
            *[now[c].alias(f"current_{c}") for c in fields],
        )

    yes, no = F.lit(True), F.lit(False)
    here, back = held("_rec", "_this"), held("_prev._rec", "_earlier")

    def any_changed(group: Sequence[str]) -> Column:
        out = F.lit(False)
        for c in group:
            out = out | ~here[c].eqNullSafe(back[c])
        return out

    adjacent = F.col("_prev._step") == F.col("_step") - 1
    apart = F.col("_prev._step") < F.col("_step") - 1
    unseen = (F.col("_row") == F.col("_rows")) & F.col("_later").isNotNull()
    changed = F.when(any_changed(values), F.lit(names["value"])).when(any_changed(metadata), F.lit(names["metadata"]))
    sha, sha_before = F.col("_rec._sha"), F.col("_prev._rec._sha")
    missing, came_back = F.lit(names["missing"]), F.lit(names["returned"])
    same_record = F.when(
        adjacent & changed.isNotNull(), event(changed, here, back, yes, yes, "_this", "_earlier", sha, sha_before)
    )
    # A gap gives two events: lost right after the earlier sighting, back at this one.
    lost = F.when(
        apart,
        event(missing, absent("_prev._later"), held("_prev._rec", "_prev._this"), no, yes, "_prev._later", "_prev._this", no_hash, sha_before),
    )
    returned = F.when(apart, event(came_back, here, absent("_earlier"), yes, no, "_this", "_earlier", sha, no_hash))
    lost_at_end = F.when(unseen, event(missing, absent("_later"), here, no, yes, "_later", "_this", no_hash, sha))
    found = lined.select(
        *scope, member, F.explode(F.array_compact(F.array(same_record, lost, returned, lost_at_end))).alias("_event")
    )
    seen = F.col("_event.event_type").isin(names["missing"], names["returned"])
    return found.select(
        *scope,
        member,
        "_event.*",
        F.when(seen, F.lit("candidate_for_investigation"))
        .otherwise(F.lit("observed_typed_record_change"))
        .alias("evidence_status"),
        F.lit(False).alias("provider_event_asserted"),
        F.lit(contract).alias("record_contract_version"),
    )
