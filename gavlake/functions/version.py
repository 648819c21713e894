"""Sortable version key as pure Column expressions (no Python in the plan).

Rules, applied to a version string ``v``:

* every character other than an ASCII digit or a dot counts as a dot, so the tokens are
  the maximal digit runs of ``v`` and ``v`` "has a dot" iff it has any non-digit;
* a token becomes a long, 0 when it does not fit;
* without a dot (all digits, or empty) the whole number is the fourth part, major is 0;
* with a first token below 922 the key is
  ``major*10^16 + minor(<=4 digits)*10^12 + incremental(<=6)*10^6 + fourth(<=6)``;
* with a first token of 922 or more the version is taken as a date: major is the number
  formed by the first 10 characters of the first token, and the key is
  ``first(<=9223372036)*10^9 + second(<=6 digits)*10^3 + third(<=3 digits)``; this sum
  wraps around like 64-bit two's complement arithmetic when it passes 2^63-1;
* the major version is clamped to 2147483647.

"Shrinking" a number to a limit keeps dividing by ten until it is within the limit, i.e.
keeps its leading digits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the version key.
MAJOR_VERSION_MAX = 922
YEAR_PREFIX_LEN = 10
YEAR_FIRST_MAX = 9223372036
# Slot limits: normal branch minor 9999, incremental 999999, fourth 999999; date-like
# branch second 999999, third 999. A limit of all nines with k digits keeps the leading
# k digits, which is how they are applied below (k = 4, 6, 6 and 6, 3).
MINOR_DIGITS, INCREMENTAL_DIGITS, FOURTH_DIGITS = 4, 6, 6
YEAR_SECOND_DIGITS, YEAR_THIRD_DIGITS = 6, 3
INT_MAX = 2147483647
LONG_MIN = -9223372036854775808
# The year-branch sum passes 2^63-1 exactly when the first part is YEAR_FIRST_MAX and
# the rest exceeds this value.
YEAR_REST_MAX = 854775807


def _to_long(token: Column) -> Column:
    """Digit string -> long; 0 when absent, empty or too large."""
    return F.coalesce(token.try_cast(T.LongType()), F.lit(0).cast(T.LongType()))


def _leading_digits(x: Column, k: int) -> Column:
    return F.substring(x.cast(T.StringType()), 1, k).cast(T.LongType())


def shrink_to_digits(x: Column, k: int) -> Column:
    """Shrink a non-negative long to the limit 10^k - 1 (keep its leading k digits)."""
    limit = 10 ** k - 1
    return F.when(x > F.lit(limit), _leading_digits(x, k)).otherwise(x)


def _shrink_year(x: Column) -> Column:
    first10 = _leading_digits(x, 10)
    return (
        F.when(x <= F.lit(YEAR_FIRST_MAX), x)
        .when(first10 <= F.lit(YEAR_FIRST_MAX), first10)
        .otherwise(_leading_digits(x, 9))
    )


def with_version_parts(df: DataFrame, version: str = "version") -> DataFrame:
    """Add the parsed parts of a version (PRJ-2, PRJ-3).

    ``_v_dot``: whether the version has anything but digits; ``_v_tok``: its digit runs;
    ``_v_t1`` .. ``_v_t4``: the first four as longs, 0 when absent or too large;
    ``_v_first10``: the first 10 characters of the first run as a long. The token array is
    a column of its own, so the regular expression runs once per row (Catalyst does not
    merge a projection that would repeat a non-trivial expression). The parts are exploded from
    an array of one: a filter on the version key stays above it, where it reads the parsed parts;
    below, it would repeat the regular expression for each of them.
    """
    v = F.col(version)
    staged = df.withColumn("_v_tok", F.regexp_extract_all(v, F.lit("([0-9]+)"), 1))
    # "has a dot" = not all digits = non-empty and not one token covering the string
    parts = {
        "_v_dot": ~((F.length(v) == 0)
                    | ((F.size("_v_tok") == 1) & (F.length(F.get(F.col("_v_tok"), 0)) == F.length(v)))),
        **{f"_v_t{i + 1}": _to_long(F.get(F.col("_v_tok"), i)) for i in range(4)},
        "_v_first10": _to_long(F.substring(F.get(F.col("_v_tok"), 0), 1, YEAR_PREFIX_LEN)),
    }
    parsed = staged.select("*", F.explode(F.array(F.struct(*[c.alias(n) for n, c in parts.items()]))).alias("_v"))
    return parsed.withColumns({n: F.col(f"_v.{n}") for n in parts}).drop("_v")


def shrink_year(x: Column) -> Column:
    """Shrink a non-negative long to the limit 9223372036 (PRJ-4)."""
    return _shrink_year(x)


def _key_from_parts(has_dot: Column, t1: Column, t2: Column, t3: Column, t4: Column,
                    first10: Column) -> tuple[Column, Column]:
    """(major, seq) from the parsed parts: has_dot, tokens as longs and the first 10
    characters of token 1 as a long.

    Without a dot the string is all digits (or empty), so its value is token 1; the
    string itself is never cast (a failing cast per row is costly).
    """
    is_year = has_dot & (t1 >= F.lit(MAJOR_VERSION_MAX))

    # Both branches are written so that neither can overflow even when evaluated for a
    # row of the other branch (Spark runs with ANSI arithmetic).
    # normal branch (also covers "no dot": then only the fourth slot is set)
    fourth = F.when(has_dot, t4).otherwise(t1)
    major_normal = F.when(has_dot, F.least(t1, F.lit(MAJOR_VERSION_MAX - 1).cast(T.LongType()))
                          ).otherwise(F.lit(0).cast(T.LongType()))
    seq_normal = (
        major_normal * F.lit(10 ** 16)
        + F.when(has_dot, shrink_to_digits(t2, MINOR_DIGITS)).otherwise(0) * F.lit(10 ** 12)
        + F.when(has_dot, shrink_to_digits(t3, INCREMENTAL_DIGITS)).otherwise(0) * F.lit(10 ** 6)
        + shrink_to_digits(fourth, FOURTH_DIGITS)
    )

    # date-like branch, with two's complement wrap
    head = _shrink_year(t1)
    rest = (shrink_to_digits(t2, YEAR_SECOND_DIGITS) * F.lit(1000)
            + shrink_to_digits(t3, YEAR_THIRD_DIGITS))
    wraps = (head == F.lit(YEAR_FIRST_MAX)) & (rest > F.lit(YEAR_REST_MAX))
    seq_year = (
        F.when(wraps, F.lit(LONG_MIN) + F.greatest(rest - F.lit(YEAR_REST_MAX + 1), F.lit(0)))
        .otherwise(head * F.lit(10 ** 9) + F.when(wraps, F.lit(0)).otherwise(rest))
    )

    major = F.when(is_year, first10).otherwise(major_normal)
    major = F.least(major, F.lit(INT_MAX).cast(T.LongType())).cast(T.IntegerType())
    seq = F.when(is_year, seq_year).otherwise(seq_normal).cast(T.LongType())
    return major, seq


def with_version_key(df: DataFrame, version: str = "version", major_out: str = "major_version",
                     seq_out: str = "version_seq") -> DataFrame:
    """Add ``major_version INT`` and ``version_seq BIGINT`` (PRJ-5, PRJ-6).

    The key arithmetic only reads the columns of ``with_version_parts``. A null version
    gives nulls.
    """
    staged = with_version_parts(df, version)
    major, seq = _key_from_parts(F.col("_v_dot"), *[F.col(f"_v_t{i}") for i in range(1, 5)],
                                 F.col("_v_first10"))
    nulled = F.col(version).isNull()
    return staged.withColumns({major_out: F.when(~nulled, major), seq_out: F.when(~nulled, seq)}
                              ).drop("_v_dot", "_v_tok", "_v_first10",
                                     *[f"_v_t{i}" for i in range(1, 5)])
