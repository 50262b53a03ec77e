"""Column-level text functions: tokenising and CSV position lists.

All of these are built-in Spark expressions, so they stay inside whole-stage
codegen and never leave the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a token is a run of Unicode letters, digits or underscore, with
# inner apostrophes kept ("Abdul's") and outer ones dropped ("'em" -> "em").
# This is the Unicode reading of the word pattern ``\b[\w']+\b``; the same text
# is valid in Java regex (Spark) and RE2 (the DuckDB oracle). It has no
# repeated group: Java recurses once per group repetition, and a long junk
# token such as a'a'a'... would overflow the task's stack.
TOKEN_PATTERN = r"[\p{L}\p{N}_](?:[\p{L}\p{N}_']*[\p{L}\p{N}_])?"


def tokenize(text: Column) -> Column:
    """array<string> of the tokens of ``text`` in order (original case)."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN_PATTERN), 0)


def lower_tokens(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.lower(t))


def first_line(text: Column) -> Column:
    return F.substring_index(F.coalesce(text, F.lit("")), "\n", 1)


def positions_csv(positions: Column) -> Column:
    """array<int> -> '3,17,40' (the text form used by the reference's tables)."""
    return F.array_join(F.transform(positions, lambda p: p.cast("string")), ",")


def positions_from_csv(csv: Column) -> Column:
    """'3,17,40' -> array<int>; '' or null -> empty array."""
    return F.when((csv.isNull()) | (csv == ""), F.array().cast("array<int>")).otherwise(
        F.transform(F.split(csv, ","), lambda s: s.cast("int"))
    )
