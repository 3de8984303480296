"""Decoders: JSON envelopes, statistical cubes, wide TSV, feature arrays, sectioned files.

A response body is one cell of one row, so all of these work row by row with higher-order
functions and explode: no shuffle, and parallel over the envelopes.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from siltstone.functions.text import DECIMAL_PATTERN, as_column, decimal_number


# --- JSON envelopes ---------------------------------------------------------------------


def explode_rows(df: DataFrame, array: Column | str, name: str) -> DataFrame:
    """One row per element of a parsed array; NULL and empty arrays give none.

    A plain ``explode`` makes the optimizer add "array is not empty" below it, which parses
    the body once more, before any repartitioning. The outer form with its position leaves
    the parse alone and still keeps NULL elements.
    """
    out = df.select("*", F.posexplode_outer(array).alias("_at", name))
    return out.where("_at is not null").drop("_at")


def step_into(df: DataFrame, level: str, name: str) -> DataFrame:
    """Explode ``parent.member`` and take the member out of the parent that is carried along.

    Otherwise every element would carry the whole array it came from, and a body would cost
    the square of its length.
    """
    parent, _, member = level.partition(".")
    if not member:
        return explode_rows(df, level, name)
    others = [c for c in df.columns if c != parent]
    alone = len(df.schema[parent].dataType.fields) == 1
    rest = [] if alone else [F.col(parent).dropFields(member).alias(parent)]
    return explode_rows(df.select(*others, *rest, F.col(level).alias("_next")), "_next", name).drop("_next")


def decode_envelopes(
    df: DataFrame,
    body: str,
    schema: str,
    levels: Sequence[str],
    fields: Mapping[str, Column | str],
    keep: Sequence[str] = (),
    mode: str = "FAILFAST",
) -> DataFrame:
    """Explode a JSON body into records.

    ``schema`` is the DDL of the whole body, parsed once. ``levels`` names what to explode,
    outermost first: ``"body"`` is the parsed body, every exploded level is then a column
    ``item0``, ``item1``, ... that the next level and ``fields`` refer to. ``keep`` lists
    provenance columns carried along. ``fields`` must not refer to an exploded array itself.
    A body that does not parse fails the query unless
    ``mode`` says otherwise; an empty or absent array gives no record.
    """
    out = df.select(*keep, F.from_json(F.col(body), schema, {"mode": mode}).alias("body"))
    for number, level in enumerate(levels):
        out = step_into(out, level, f"item{number}")
    return out.select(*keep, *[as_column(expr).alias(name) for name, expr in fields.items()])


_MEMBER = re.compile(r"\$\.([A-Za-z_][A-Za-z0-9_]*)")


def _picked(item: str, fields: Mapping[str, str]) -> tuple[Column, list[Column]]:
    """Parsed item and the typed columns picked from it.

    All plain members come from one parse; only deeper paths are looked up one by one.
    """
    members = {_MEMBER.fullmatch(spec.split(" ", 1)[1]) for spec in fields.values()}
    names = sorted({m.group(1) for m in members if m})
    parsed = F.from_json(item, ", ".join(f"`{n}` string" for n in names) or "`_` string")
    columns = []
    for output, spec in fields.items():
        kind, path = spec.split(" ", 1)
        member = _MEMBER.fullmatch(path)
        value = F.col(f"_parsed.{member.group(1)}") if member else F.get_json_object(item, path)
        columns.append((value if kind == "string" else value.try_cast(kind)).alias(output))
    return parsed, columns


def _read_items(items: DataFrame, fields: Mapping[str, str], keep: Sequence[str | Column], raw: str | None) -> DataFrame:
    parsed, columns = _picked("_item", fields)
    out = items.select("*", parsed.alias("_parsed")).select(*keep, *columns, "_item")
    return out.drop("_item") if raw is None else out.withColumnRenamed("_item", raw)


def decode_json_items(
    df: DataFrame, body: str, path: str, fields: Mapping[str, str], keep: Sequence[str | Column] = (), raw: str | None = None
) -> DataFrame:
    """Explode a JSON array whose items vary, keeping each item's exact text.

    ``fields`` maps output -> "kind $.path"; nested objects and arrays come out as JSON text.
    """
    items = explode_rows(df, F.from_json(F.get_json_object(F.col(body), path), "array<string>"), "_item")
    return _read_items(items, fields, keep, raw)


def decode_catalogue_detail(
    df: DataFrame,
    body: str,
    *,
    is_catalogue: Column,
    is_detail: Column,
    items: str,
    page_fields: Mapping[str, str],
    fields: Mapping[str, str],
    keep: Sequence[str | Column],
    raw: str = "source_record_json",
) -> DataFrame:
    """Catalogue pages (many records) and detail responses (one record) as one stream.

    Page-level fields are NULL on detail records. ``response_kind`` tells them apart. Both
    kinds come from one scan: a detail body is its own only item.
    """
    kind = F.when(is_catalogue, F.lit("catalogue")).when(is_detail, F.lit("detail"))
    listed = F.col("response_kind") == "catalogue"
    tagged = df.select("*", kind.alias("response_kind")).where("response_kind is not null")
    paged = tagged.select("*", *[F.when(listed, _page_field(body, spec)).alias(n) for n, spec in page_fields.items()])
    nested = F.from_json(F.get_json_object(F.col(body), items), "array<string>")
    rows = explode_rows(paged, F.when(listed, nested).otherwise(F.array(F.col(body))), "_item")
    return _read_items(rows, fields, [*keep, "response_kind", *page_fields], raw)


def _page_field(body: str, spec: str) -> Column:
    kind, path = spec.split(" ", 1)
    value = F.get_json_object(F.col(body), path)
    return value if kind == "string" else value.try_cast(kind)


# --- statistical cubes ------------------------------------------------------------------

# Cells that are made in one step.
CUBE_BLOCK = 4096

CUBE_SCHEMA = (
    "version string, class string, label string, updated string, id array<string>, size array<bigint>, "
    "dimension map<string, struct<category: struct<index: string>>>, value string, status string"
)


def _is_list(text: Column) -> Column:
    return F.startswith(F.ltrim(text), F.lit("["))


def _codes(index: Column) -> Column:
    """Category codes in position order, from either spelling of the index."""
    entries = F.map_entries(F.from_json(index, "map<string,int>"))
    ordered = F.array_sort(F.transform(entries, lambda e: F.struct(e["value"].alias("p"), e["key"].alias("c"))))
    return F.when(_is_list(index), F.from_json(index, "array<string>")).otherwise(
        F.transform(ordered, lambda e: e["c"])
    )


def _well_placed(index: Column) -> Column:
    """Whether an index gives every code one place, without gaps, and no code twice."""
    places = F.array_sort(F.map_values(F.from_json(index, "map<string,int>")))
    wanted = F.when(F.size(places) > 0, F.sequence(F.lit(0), F.size(places) - 1)).otherwise(F.array().cast("array<int>"))
    codes = F.from_json(index, "array<string>")
    return F.when(_is_list(index), F.size(F.array_distinct(codes)) == F.size(codes)).otherwise(places == wanted)


def _as_json(shown: Column, typed: Column) -> Column:
    """A member's JSON text: numbers as they were written, texts in their quotes."""
    return F.when(F.schema_of_variant(typed) == "STRING", F.to_json(typed)).otherwise(shown)


def _entries(text: Column, typed: bool = False) -> Column:
    """Sorted (position, value) pairs of a sparse position map; NULL for the list form. ``typed`` keeps values as JSON text."""
    pairs = F.map_entries(F.from_json(text, "map<string,string>"))
    if typed:
        kinds = F.map_values(F.from_json(text, "map<string,variant>"))
        pairs = F.zip_with(pairs, kinds, lambda e, k: F.struct(e["key"].alias("key"), _as_json(e["value"], k).alias("value")))
    placed = F.transform(pairs, lambda e: F.struct(e["key"].cast("long").alias("p"), e["value"].alias("v")))
    return F.when(~_is_list(text), F.array_sort(placed))


def _listed(text: Column, typed: bool) -> Column:
    shown = F.from_json(text, "array<string>")
    return F.zip_with(shown, F.from_json(text, "array<variant>"), _as_json) if typed else shown


def _dense(text: Column, given: Column, total: Column, typed: bool = False) -> Column:
    """Array with one entry per cube position, from a full list or from sorted sparse pairs.

    The sparse form is filled from gap to gap, which is linear in the cube; looking every
    position up in the map would be quadratic. ``given`` has to be a stored column, because
    the lambda reads it for every pair.
    """
    blanks = lambda n: F.array_repeat(F.lit(None).cast("string"), n.cast("int"))
    stretches = F.transform(
        given,
        lambda e, i: F.concat(
            F.array(e["v"]), blanks(F.coalesce(F.try_element_at(given, i + 2)["p"], total) - e["p"] - 1)
        ),
    )
    sparse = F.concat(blanks(F.coalesce(F.try_element_at(given, F.lit(1))["p"], total)), F.flatten(stretches))
    return F.when(text.isNull(), blanks(total)).when(given.isNull(), _listed(text, typed)).otherwise(sparse)


def decode_cube(df: DataFrame, body: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per cube cell in row-major order, missing cells included.

    Adds the cell's position, its complete dimension key as sorted JSON with its hash, the
    value as JSON text and, where it is a JSON number, as a number, its status, and whether it is missing. A body that is no
    consistent cube fails the query: an absent value member, dimensions that are repeated, unlisted
    or without a size of their own, codes without one place each, or lists of the wrong length.

    Everything that belongs to the cube and not to the cell (code lists, strides, the JSON
    piece of every code) is prepared once per body, before the cells explode.
    """
    parsed = df.select(*keep, F.from_json(F.col(body), CUBE_SCHEMA, {"mode": "FAILFAST"}).alias("c"))
    total = F.aggregate(F.col("c.size"), F.lit(1).cast("long"), lambda acc, s: acc * s)
    dims = F.transform(
        F.col("c.id"),
        lambda name, i: F.struct(
            name.alias("name"),
            _codes(F.element_at(F.col("c.dimension"), name)["category"]["index"]).alias("codes"),
            F.element_at(F.col("c.size"), i + 1).alias("size"),
            F.aggregate(
                F.slice(F.col("c.size"), i + 2, F.greatest(F.size("c.size") - i - 1, F.lit(0))),
                F.lit(1).cast("long"),
                lambda acc, s: acc * s,
            ).alias("stride"),
            _well_placed(F.element_at(F.col("c.dimension"), name)["category"]["index"]).alias("placed"),
        ),
    )
    laid = parsed.select(
        *keep,
        "c",
        total.alias("total"),
        F.array_sort(dims).alias("dims"),
        _entries(F.col("c.value"), typed=True).alias("given"),
        _entries(F.col("c.status")).alias("marks"),
    )
    filled = laid.select(
        *keep,
        "c",
        "total",
        "dims",
        _dense(F.col("c.value"), F.col("given"), F.col("total"), typed=True).alias("values"),
        _dense(F.col("c.status"), F.col("marks"), F.col("total")).alias("statuses"),
        # to_json of a one-entry map is {"name":"code"}; without its braces it is the piece of the key.
        F.transform(
            "dims",
            lambda d: F.transform(
                d["codes"], lambda code: F.regexp_extract(F.to_json(F.create_map(d["name"], code)), r"(?s)^\{(.*)\}$", 1)
            ),
        ).alias("pieces"),
    )
    sound = (
        (F.col("c.version") == "2.0")
        & (F.col("c.class") == "dataset")
        & F.col("c.value").isNotNull()
        & (F.size("c.id") == F.size("c.size"))
        & (F.size(F.array_distinct("c.id")) == F.size("c.id"))
        & (F.size(F.array_except(F.map_keys("c.dimension"), "c.id")) == 0)
        & F.forall("dims", lambda d: d["placed"])
        & F.forall("dims", lambda d: F.size(d["codes"]) == d["size"])
        & (F.size("values") == F.col("total"))
        & (F.size("statuses") == F.col("total"))
    )
    checked = F.when(F.coalesce(sound, F.lit(False)), F.arrays_zip("values", "statuses")).otherwise(
        F.raise_error(F.lit("inconsistent statistical cube"))
    )
    blocks = filled.select(*keep, "c.label", "c.updated", "dims", "pieces", "total", checked.alias("cells"))
    # Cells are made block by block with the code lists read in place: an exploded row carries
    # its own values only, never the lists.
    blocks = explode_rows(
        blocks,
        F.transform(
            F.sequence(F.lit(0).cast("long"), F.col("total") - 1, F.lit(CUBE_BLOCK).cast("long")),
            lambda s: F.struct(s.alias("start"), F.slice("cells", (s + 1).cast("int"), F.lit(CUBE_BLOCK)).alias("part")),
        ),
        "block",
    )

    def at(position: Column, d: Column) -> Column:
        return (F.floor(position / d["stride"]) % d["size"] + 1).cast("int")

    def cell(c: Column, i: Column) -> Column:
        position = F.col("block.start") + i
        codes = F.transform("dims", lambda d: F.element_at(d["codes"], at(position, d)))
        key = F.transform("dims", lambda d, k: F.element_at(F.element_at(F.col("pieces"), k + 1), at(position, d)))
        return F.struct(
            position.cast("int").alias("position"),
            F.map_from_arrays(F.transform("dims", lambda d: d["name"]), codes).alias("dimensions"),
            F.concat(F.lit("{"), F.array_join(key, ","), F.lit("}")).alias("dimension_key_json"),
            c["values"].alias("value"),
            c["statuses"].alias("status"),
        )

    made = blocks.select(*keep, "label", "updated", F.transform("block.part", cell).alias("made"))
    return explode_rows(made, "made", "cell").select(
        *keep,
        "label",
        "updated",
        "cell.position",
        "cell.dimensions",
        F.coalesce(F.col("cell.value"), F.lit("null")).alias("value_json"),
        decimal_number("cell.value").alias("value_numeric"),
        F.col("cell.status").alias("status_code"),
        F.col("cell.value").isNull().alias("is_missing"),
        "cell.dimension_key_json",
        F.sha2("cell.dimension_key_json", 256).alias("dimension_key_sha256"),
    )


# --- wide TSV ---------------------------------------------------------------------------


def decode_wide_tsv(
    lines: DataFrame, line: str, header: str, keep: Sequence[str] = (), line_number: str | None = None
) -> DataFrame:
    """One row per (series, period) cell of a wide TSV.

    ``header`` holds each line's own header (``dim,dim\\TIME_PERIOD<TAB>period...``), so
    files with different dimensions and periods decode together. A cell is a value with an
    optional flag behind a blank; ``:`` and blank cells are missing. Lines that do not fit
    their header, headers with a period twice, and values that are no number fail the query.
    """
    head = F.split(F.regexp_replace(F.col(header), "\r$", ""), "\t")
    names = F.transform(F.split(F.split(head[0], r"\\")[0], ","), lambda n: F.lower(F.trim(n)))
    periods = F.transform(F.slice(head, F.lit(2), F.size(head) - 1), lambda p: F.trim(p))
    cells = F.split(F.regexp_replace(F.col(line), "\r$", ""), "\t", -1)
    codes = F.transform(F.split(cells[0], ","), lambda c: F.trim(c))
    parsed = lines.select(
        *keep,
        *([F.col(line_number).alias("source_row_number")] if line_number else []),
        names.alias("names"),
        periods.alias("periods"),
        codes.alias("codes"),
        F.slice(cells, F.lit(2), F.size(cells) - 1).alias("cells"),
        F.upper(F.trim(F.split(head[0], r"\\")[1])).alias("axis"),
    )
    fits = (
        (F.col("axis") == "TIME_PERIOD")
        & (F.size("names") == F.size("codes"))
        & (F.size("periods") > 0)
        & (F.size(F.array_distinct("periods")) == F.size("periods"))
        & (F.size("periods") == F.size("cells"))
        & F.forall("codes", lambda c: c != "")
    )
    checked = F.when(F.coalesce(fits, F.lit(False)), F.arrays_zip("periods", "cells")).otherwise(
        F.raise_error(F.lit("line does not fit its header"))
    )
    carried = [*keep, *(["source_row_number"] if line_number else [])]
    # The key of a cell is the key of its series with the period put in its sorted place.
    named = F.array_sort(F.arrays_zip("names", "codes"))
    piece = lambda k, v: F.regexp_extract(F.to_json(F.create_map(k, v)), r"(?s)^\{(.*)\}$", 1)

    def joined(part: Column) -> Column:
        return F.array_join(F.transform(part, lambda s: piece(s["names"], s["codes"])), ",")

    prepared = parsed.select(*carried, named.alias("series"), checked.alias("cells")).select(
        *carried,
        "series",
        "cells",
        joined(F.filter("series", lambda s: s["names"] < "time")).alias("key_head"),
        joined(F.filter("series", lambda s: s["names"] > "time")).alias("key_tail"),
    )
    series = prepared.select(*carried, "series", "key_head", "key_tail", F.posexplode_outer("cells").alias("at", "cell"))
    # Any white space may pad a cell or stand between value and flag.
    text = F.regexp_replace(F.col("cell.cells"), r"^\s+|\s+$", "")
    parts = F.regexp_replace(text, r"\s+", " ")
    split_cells = series.select(
        *carried,
        "series",
        F.col("cell.periods").alias("period_key"),
        (F.col("at") + 1).alias("source_period_position"),
        F.concat(
            F.lit("{"), F.concat_ws(",", F.nullif("key_head", F.lit("")), piece(F.lit("time"), F.col("cell.periods")), F.nullif("key_tail", F.lit(""))), F.lit("}")
        ).alias("dimension_key_json"),
        F.substring_index(parts, " ", 1).alias("value_text"),
        F.when(F.contains(parts, F.lit(" ")), F.regexp_extract(text, r"^\S+\s+(.*)$", 1)).alias("status_code"),
    )
    known = ~F.col("value_text").isin("", ":")
    numbered = split_cells.select("*", decimal_number("value_text").alias("_number"))
    finite = F.col("_number").isNotNull() & (F.abs("_number") != F.lit(float("inf")))
    return numbered.select(
        *carried,
        F.map_concat(
            F.map_from_arrays(F.transform("series", lambda s: s["names"]), F.transform("series", lambda s: s["codes"])),
            F.create_map(F.lit("time"), "period_key"),
        ).alias("dimensions"),
        "period_key",
        "value_text",
        F.when(known & finite, F.col("_number"))
        .when(known, F.raise_error(F.lit("cell is not a finite number")).cast("double"))
        .alias("value_numeric"),
        "status_code",
        (~known).alias("is_missing"),
        F.when(F.col("value_text") == "", F.lit("empty")).when(F.col("value_text") == ":", F.lit("colon")).alias("missing_reason"),
        "source_period_position",
        "dimension_key_json",
        F.sha2("dimension_key_json", 256).alias("dimension_key_sha256"),
    )


# --- feature arrays ---------------------------------------------------------------------


def first_feature(features: Column | str, key: str) -> Column:
    """First non-NULL value of ``key`` over an array of maps."""
    held = F.filter(as_column(features), lambda m: F.try_element_at(m, F.lit(key)).isNotNull())
    return F.try_element_at(F.try_element_at(held, F.lit(1)), F.lit(key))


def flatten_features(df: DataFrame, features: str, columns: Mapping[str, str], keep: Sequence[str | Column] = ()) -> DataFrame:
    """Wide entity rows from feature arrays. ``columns`` maps output -> "kind KEY"."""
    picked = []
    for output, spec in columns.items():
        kind, key = spec.split(" ", 1)
        value = first_feature(features, key)
        picked.append((decimal_number(value) if kind == "double" else value).alias(output))
    return df.select(*keep, *picked)


# --- sectioned files --------------------------------------------------------------------

# Fixed pattern: hashes of 64 to 128 hex digits.
HASH_PATTERN = r"^[0-9a-fA-F]{64,128}$"


def bank_prefix(mask: Column | str) -> Column:
    """Characters 3 to 10 of an account mask, blank for shorter masks."""
    mask = as_column(mask)
    return F.when(F.length(mask) >= 10, F.substring(mask, 3, 8)).otherwise(F.lit(""))


def explode_sections(df: DataFrame, sections: Mapping[str, str], value: str, tag: str, pattern: str = HASH_PATTERN, keep: Sequence[str] = ()) -> DataFrame:
    """Members of several array columns in one column, tagged, kept if they fit ``pattern``.

    ``sections`` maps array column -> tag value.
    """
    groups = F.array(*[F.struct(F.lit(t).alias(tag), F.col(c).alias("_members")) for c, t in sections.items()])
    return (
        df.select(*keep, F.inline(groups))
        .select(*keep, tag, F.explode("_members").alias(value))
        .where(F.col(value).rlike(pattern))
        .select(*keep, value, tag)
    )


def is_decimal(value: Column | str) -> Column:
    return as_column(value).rlike(DECIMAL_PATTERN)
