"""Column-name normalization and de-duplication as plain Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Longest normalized name and the prefixes the target reserves.
MAX_NAME_LENGTH = 300
RESERVED_PREFIX = "^_(TABLE|FILE|PARTITION)_"

# The Unicode characters that count as white space around a name.
WHITESPACE = "".join(
    chr(c)
    for c in [
        *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
        *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    ]
)


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip_whitespace(text: Column) -> Column:
    """Trim Unicode white space (Spark's own ``trim`` removes U+0020 only)."""
    return F.btrim(text, F.lit(WHITESPACE))


def normalize_name(name: Column | str) -> Column:
    """Target-safe form of a source column name.

    White space and one enclosing pair of double quotes go; every run of
    characters other than letters and digits becomes one ``_``; a name that
    would start with a digit gets a leading ``_``; trailing ``_`` goes; an empty
    name becomes ``_``; the result is cut to 300 code points, gets one more
    ``_`` when it starts with a reserved prefix, and is lower-cased.

    The mapping is not idempotent (the cut can leave a trailing ``_``): apply it
    once and keep the result.
    """
    text = strip_whitespace(F.coalesce(_column(name), F.lit("")))
    # A lone double quote counts as an enclosing pair around nothing.
    text = strip_whitespace(F.regexp_replace(text, r'(?s)\A"(?:(.*)")?\z', "$1"))
    text = F.regexp_replace(text, r"[^\p{L}\p{N}]+", "_")
    # No two `_` are adjacent now, so one spare character covers the one that may be
    # trimmed below: the later steps need not carry a long text along.
    text = F.substring(text, 1, MAX_NAME_LENGTH + 1)
    text = F.regexp_replace(text, r"\A(?=[^\p{L}_])", "_")
    text = F.substring(F.rtrim(text, F.lit("_")), 1, MAX_NAME_LENGTH)
    text = F.regexp_replace(text, r"\A\z", "_")
    suffix = F.when(F.upper(text).rlike(RESERVED_PREFIX), F.lit("_")).otherwise(F.lit(""))
    return F.lower(F.concat(text, suffix))


def numbered_name(base: Column, number: Column) -> Column:
    """``base_2``, ``base_3``, …; the placeholder ``_`` numbers as ``_2``, ``_3``."""
    return F.concat(F.when(base == "_", F.lit("")).otherwise(base), F.lit("_"), number.cast("string"))


def dedup_names(names: Column | str) -> Column:
    """Make the names of one table unique, left to right.

    A name already taken is tried with suffixes 2, 3, … until one is free. The
    choice depends on the names *assigned* so far, so a rank over equal names would
    be wrong and this is a fold over the array. The array holds one table's column
    list, which the catalog bounds; tables are folded in parallel.
    """

    def step(taken: Column, base: Column) -> Column:
        candidates = F.transform(
            F.sequence(F.lit(2), F.size(taken) + 2), lambda k: numbered_name(base, k)
        )
        free = F.when(~F.array_contains(taken, base), base).otherwise(
            F.element_at(F.array_except(candidates, taken), 1)
        )
        return F.array_append(taken, free)

    return F.aggregate(_column(names), F.array().cast("array<string>"), step)
