"""Text, number-in-text and code helpers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# The blanks that appear as thousands separators in provider files
# (space, no-break space, narrow no-break space).
NUMBER_BLANKS = "\u0020\u00a0\u202f"

# Fixed pattern: a plain decimal number. Spark's own cast also takes Java suffixes
# ("1d", "2f"), which no provider means as a number.
DECIMAL_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def clean_text(value: Column | str, blank_to_null: bool = True, case: str | None = None) -> Column:
    """Trim, optionally fold case, optionally turn blank text into NULL."""
    out = F.trim(as_column(value))
    if case == "upper":
        out = F.upper(out)
    elif case == "lower":
        out = F.lower(out)
    elif case is not None:
        raise ValueError(f"unknown case folding {case!r}")
    return F.nullif(out, F.lit("")) if blank_to_null else out


def joined_label(*parts: Column | str, sep: str = " / ") -> Column:
    """Join the non-blank parts; NULL and empty parts leave no separator behind."""
    return F.concat_ws(sep, *[F.nullif(as_column(p), F.lit("")) for p in parts])


def concat_skip_null(*parts: Column | str) -> Column:
    """Concatenate and skip NULLs (Spark's ``concat`` would return NULL)."""
    return F.concat_ws("", *[as_column(p).cast("string") for p in parts])


def decimal_number(value: Column | str) -> Column:
    """Double from plain decimal text, NULL for anything else."""
    text = F.trim(as_column(value))
    return F.when(text.rlike(DECIMAL_PATTERN), text.try_cast("double"))


def local_number(value: Column | str) -> Column:
    """Double from text with blank thousands separators and a decimal comma."""
    packed = F.translate(F.coalesce(as_column(value), F.lit("")), NUMBER_BLANKS, "")
    return decimal_number(F.replace(packed, F.lit(","), F.lit(".")))


def whole_number(value: Column | str) -> Column:
    """Integer from text; decimals are rounded, out-of-range and other text give NULL."""
    text = F.trim(as_column(value))
    return F.coalesce(text.try_cast("int"), F.round(decimal_number(text)).try_cast("int"))


def period_year(value: Column | str) -> Column:
    """Year of a period label: the whole text as a number, else its first four-digit run."""
    text = F.trim(as_column(value))
    return F.coalesce(whole_number(text), F.regexp_extract(text, "([0-9]{4})", 1).try_cast("int"))


def unit_code(value: Column | str) -> Column:
    """Pad a territorial unit code to the next length class (2, 4, 7 or 12 digits)."""
    code = F.trim(F.coalesce(as_column(value), F.lit("")))
    size = F.length(code)
    padded = F.when(size == 0, F.lit(""))
    for width in (2, 4, 7, 12):
        padded = padded.when(size <= width, F.lpad(code, width, "0"))
    return padded.otherwise(code)


def territory_code(value: Column | str) -> Column:
    """Seven-digit territory code held in a 6/7-digit code or inside an 11/12-digit unit id."""
    code = F.trim(F.coalesce(as_column(value), F.lit("")))
    size = F.length(code)
    return (
        F.when(size.isin(6, 7), F.lpad(code, 7, "0"))
        .when(size.isin(11, 12), F.substring(F.lpad(code, 12, "0"), 3, 7))
    )


def code_label(value: Column | str, labels: Mapping[str, str], default: Column | None = None) -> Column:
    """Map a code to its label; unknown codes give ``default`` (NULL if none)."""
    source = as_column(value)
    out = None
    for code, label in labels.items():
        hit = source == F.lit(code)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    if out is None:
        return F.lit(None).cast("string") if default is None else default
    return out if default is None else out.otherwise(default)


def any_zero(*measures: Column | str) -> Column:
    """True if any measure is exactly zero; NULL measures count as not zero."""
    out = F.lit(False)
    for measure in measures:
        out = out | F.coalesce(as_column(measure) == 0, F.lit(False))
    return out


def is_finite(value: Column | str) -> Column:
    number = as_column(value).cast("double")
    return ~F.isnan(number) & (F.abs(number) != F.lit(float("inf")))


def round_half_up(value: Column | str, digits: int) -> Column:
    """Binary rounding, as C-like engines do it; Spark's ``round`` works on decimal text."""
    scale = float(10**digits)
    return F.floor(as_column(value) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def ratio(part: Column | str, whole: Column | str) -> Column:
    """part / whole as a double, NULL unless the whole is positive."""
    whole = as_column(whole)
    return F.when(whole > 0, as_column(part).cast("double") / whole)


def recode(value: Column | str, read_as: str, really: str) -> Column:
    """Repair text whose bytes were read in another single-byte encoding.

    Spark reads a short list of encodings. ISO-8859-1 among them keeps every byte, so text
    in any other single-byte encoding is read as that and mapped to what it really says.
    """
    upper = bytes(range(0xA0, 0x100))
    return F.translate(as_column(value), upper.decode(read_as), upper.decode(really))
