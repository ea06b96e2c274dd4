"""Text cleaning and parsing as JVM-side column expressions (no Python UDFs).

The cleaning rules follow Python's ``str.strip`` / ``float`` / ``int(float(x))`` /
``datetime.strptime(x, "%d/%m/%Y %H:%M:%S")`` because the original loader used them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.isspace() accepts, generated from that rule.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

# The same set as a Java regex character-class body (\x{..} escapes).
WS_CLASS = "".join(f"\\x{{{ord(c):x}}}" for c in WHITESPACE)

# Python float() grammar (ASCII digits; underscores are not accepted here).
NUMBER_RE = r"^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity|nan))$"

# strptime("%d/%m/%Y %H:%M:%S") field grammar; a space in the format matches a whitespace run.
TIMESTAMP_RE = (
    r"^(3[01]|[12][0-9]|0[1-9]|[1-9])/(1[0-2]|0[1-9]|[1-9])/(000[1-9]|00[1-9][0-9]|0[1-9][0-9]{2}|[1-9][0-9]{3})"
    rf"[{WS_CLASS}]+"
    r"(2[0-3]|[01][0-9]|[0-9]):([0-5][0-9]|[0-9]):([0-5][0-9]|[0-9])$"
)


def strip(c: Column) -> Column:
    """Remove leading/trailing whitespace (Python's definition); null stays null.

    ``btrim`` with a character set scans and allocates on every call, so it runs
    only when the first or last character is whitespace (two one-character
    hash-set lookups otherwise).
    """
    ws = list(WHITESPACE)
    at_ends = F.substring(c, 1, 1).isin(*ws) | F.substring(c, -1, 1).isin(*ws)
    return F.when(at_ends, F.btrim(c, F.lit(WHITESPACE))).otherwise(c)


def text_or_empty(c: Column) -> Column:
    """Stripped text; a missing cell reads as ''."""
    return F.coalesce(strip(c), F.lit(""))


def float_of_stripped(t: Column) -> Column:
    """``float(t)`` for already-stripped text."""
    # behind the grammar guard the cast fails only for a signed nan ("+nan", "-nan")
    return F.when(t.rlike(NUMBER_RE), F.coalesce(t.try_cast("double"), F.lit(float("nan"))))


def int_of_stripped(t: Column) -> Column:
    return float_of_stripped(t).try_cast("bigint")


def timestamp_of_stripped(t: Column) -> Column:
    """Day-first ``d/m/Y H:M:S`` (already-stripped text) to timestamp_ntz; invalid gives null."""
    # behind the grammar guard the digit groups are exactly day, month, year, hour, minute,
    # second; otherwise the array is null and so is the result.  The array is an unconditional
    # common sub-expression, so it is extracted once per row (not once per field).
    parts = F.when(t.rlike(TIMESTAMP_RE), F.regexp_extract_all(t, F.lit("[0-9]+"), 0))

    def part(i: int) -> Column:
        return F.get(parts, i).try_cast("int")

    return F.try_make_timestamp_ntz(part(2), part(1), part(0), part(3), part(4), part(5))


def parse_float(c: Column) -> Column:
    """Python ``float(x.strip())``: bad or blank text gives null; accepts nan/inf."""
    return float_of_stripped(strip(c))


def parse_int(c: Column) -> Column:
    """Python ``int(float(x))``: truncates toward zero; nan, inf and overflow give null."""
    return int_of_stripped(strip(c))


def parse_timestamp(c: Column) -> Column:
    """Python ``datetime.strptime(x.strip(), "%d/%m/%Y %H:%M:%S")``; invalid gives null."""
    return timestamp_of_stripped(strip(c))
