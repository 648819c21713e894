"""Declared-limit checks (QLT-1): report, fail on, or quarantine rows that break a
``varchar(n)`` or NOT NULL limit of the target schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import COLUMN_LIMITS


def _rules(table: str, columns: list[str]):
    return [(c, n, nn) for t, c, n, nn in COLUMN_LIMITS if t == table and c in columns]


def _violations(df: DataFrame, table: str) -> F.Column:
    """Array of (column, rule, length) structs, one per broken limit of the row."""
    checks = []
    for col, max_len, not_null in _rules(table, df.columns):
        if not_null:
            checks.append(F.when(F.col(col).isNull(), F.struct(
                F.lit(col).alias("column_name"), F.lit("not_null").alias("rule"),
                F.lit(None).cast(T.IntegerType()).alias("actual_length"))))
        if max_len is not None:
            n = F.length(F.col(col)).cast(T.IntegerType())
            checks.append(F.when(n > max_len, F.struct(
                F.lit(col).alias("column_name"), F.lit(f"max_length_{max_len}").alias("rule"),
                n.alias("actual_length"))))
    if not checks:
        return F.array().cast("array<struct<column_name:string,rule:string,actual_length:int>>")
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def _any_violation(df: DataFrame, table: str) -> F.Column:
    """True when the row breaks at least one declared limit (a plain OR, no arrays)."""
    cond = F.lit(False)
    for col, max_len, not_null in _rules(table, df.columns):
        if not_null:
            cond = cond | F.col(col).isNull()
        if max_len is not None:
            cond = cond | F.coalesce(F.length(F.col(col)) > max_len, F.lit(False))
    return cond


def length_violations(df: DataFrame, table: str, key: str = "uinfo_md5") -> DataFrame:
    """One row per (record, broken limit): key, table, column, rule, actual length.

    A single pass over the table; no per-rule scan. The cheap combined test runs first,
    so the per-rule detail is only built for the (rare) rows that break a limit.
    """
    bad = df.filter(_any_violation(df, table))
    return bad.select(F.col(key), F.explode(_violations(bad, table)).alias("v")).select(
        F.lower(F.hex(F.col(key))).alias(key), F.lit(table).alias("table_name"),
        "v.column_name", "v.rule", "v.actual_length")


def with_reject_flag(df: DataFrame, table: str, flag: str = "rejected") -> DataFrame:
    """Quarantine mode as one column: ``flag`` is true for rows breaking a limit."""
    return df.withColumn(flag, _any_violation(df, table))


def enforce_limits(df: DataFrame, table: str) -> DataFrame:
    """Fail mode: the job that writes the result raises on the first broken limit.

    The check is folded into the first (key) column, ``CASE WHEN bad THEN raise_error
    ELSE key END``: unlike a filter it is not pushed below the projections (which
    would repeat e.g. the JSON parse in the condition), and unlike an extra column it
    cannot be pruned while the key is read (a table write reads every column).
    """
    bad = _any_violation(df, table)
    first = df.schema.fields[0]
    key = F.col(first.name)
    key_text = F.hex(key) if isinstance(first.dataType, T.BinaryType) else key.cast("string")
    checked = F.when(bad, F.raise_error(
        F.concat(F.lit(f"{table}: declared limit broken for key "), key_text)
    ).cast(first.dataType)).otherwise(key)
    return df.withColumn(first.name, checked)
