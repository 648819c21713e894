"""The package's functions for ``spark.sql``: SQL functions, no Python behind them.

``register_functions`` makes them temporary functions of a session, or lasting ones of a catalog
database. They are inlined into the query's expressions, so they run inside its codegen stages.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators.views import quoted
from ..schemas import AVAILABILITY_CODES, DOWNLOAD_COMMAND_PREFIX, UINFO_MAX_LEN, UNSTABLE_VERSION_WORDS
from .columns import JSON_ELEMENTS, MAX_DATETIME_MS
from .version import (
    FOURTH_DIGITS,
    INCREMENTAL_DIGITS,
    INT_MAX,
    MAJOR_VERSION_MAX,
    MINOR_DIGITS,
    YEAR_FIRST_MAX,
    YEAR_PREFIX_LEN,
    YEAR_SECOND_DIGITS,
    YEAR_THIRD_DIGITS,
)


def _nines(digits: int) -> str:
    return f"{10 ** digits - 1}L"


# A version's parts are handed on as arguments, so each is written once: (name, parameters, type, body).
# ``{f}`` stands before the package's own functions (a database, or nothing).
SCALARS = (
    ("version_tokens", "v STRING", "ARRAY<STRING>", "regexp_extract_all(v, '([0-9]+)', 1)"),
    ("safe_long", "token STRING", "BIGINT", "coalesce(try_cast(token AS BIGINT), 0L)"),
    # divided by ten until within the limit: as many leading digits as the limit has, or one less
    ("shrink_long", "value BIGINT, upto BIGINT", "BIGINT", """
        CASE WHEN value IS NULL OR upto IS NULL THEN NULL
             WHEN value <= upto THEN value
             WHEN {f}safe_long(left(string(value), length(string(upto)))) <= upto
               THEN {f}safe_long(left(string(value), length(string(upto))))
             ELSE {f}safe_long(left(string(value), length(string(upto)) - 1)) END"""),
    ("version_has_dot", "v STRING", "BOOLEAN", "v RLIKE '[^0-9]'"),
    ("_major_of", "has_dot BOOLEAN, tokens ARRAY<STRING>", "INT", f"""
        cast(least(CASE WHEN NOT has_dot THEN 0L
                        WHEN {{f}}safe_long(get(tokens, 0)) < {MAJOR_VERSION_MAX} THEN {{f}}safe_long(get(tokens, 0))
                        ELSE {{f}}safe_long(left(get(tokens, 0), {YEAR_PREFIX_LEN})) END, {INT_MAX}L) AS INT)"""),
    ("major_version", "v STRING", "INT", """
        CASE WHEN v IS NOT NULL THEN {f}_major_of({f}version_has_dot(v), {f}version_tokens(v)) END"""),
    # a date-like key may pass 2^63 - 1 and wraps like 64-bit arithmetic
    ("_wrapped", "n DECIMAL(20,0)", "BIGINT",
     "cast(CASE WHEN n > 9223372036854775807BD THEN n - 18446744073709551616BD ELSE n END AS BIGINT)"),
    ("_plain_seq", "major BIGINT, t2 BIGINT, t3 BIGINT, t4 BIGINT", "BIGINT", f"""
        major * 10000000000000000L + {{f}}shrink_long(t2, {_nines(MINOR_DIGITS)}) * 1000000000000L
        + {{f}}shrink_long(t3, {_nines(INCREMENTAL_DIGITS)}) * 1000000L
        + {{f}}shrink_long(t4, {_nines(FOURTH_DIGITS)})"""),
    ("_date_seq", "t1 BIGINT, t2 BIGINT, t3 BIGINT", "BIGINT", f"""
        {{f}}_wrapped(cast({{f}}shrink_long(t1, {YEAR_FIRST_MAX}L) AS DECIMAL(10,0)) * 1000000000BD
                     + {{f}}shrink_long(t2, {_nines(YEAR_SECOND_DIGITS)}) * 1000L
                     + {{f}}shrink_long(t3, {_nines(YEAR_THIRD_DIGITS)}))"""),
    ("_seq_of", "has_dot BOOLEAN, t1 BIGINT, t2 BIGINT, t3 BIGINT, t4 BIGINT", "BIGINT", f"""
        CASE WHEN NOT has_dot THEN {{f}}_plain_seq(0L, 0L, 0L, t1)
             WHEN t1 < {MAJOR_VERSION_MAX} THEN {{f}}_plain_seq(t1, t2, t3, t4)
             ELSE {{f}}_date_seq(t1, t2, t3) END"""),
    ("_seq_of_tokens", "has_dot BOOLEAN, tokens ARRAY<STRING>", "BIGINT", """
        {f}_seq_of(has_dot, {f}safe_long(get(tokens, 0)), {f}safe_long(get(tokens, 1)),
                  {f}safe_long(get(tokens, 2)), {f}safe_long(get(tokens, 3)))"""),
    ("version_seq", "v STRING", "BIGINT", """
        CASE WHEN v IS NOT NULL THEN {f}_seq_of_tokens({f}version_has_dot(v), {f}version_tokens(v)) END"""),
    ("group_prefix", "group_id STRING, parts INT", "STRING", "substring_index(group_id, '.', parts)"),
    ("download_command", "group_id STRING, artifact_id STRING, version STRING, extension STRING, "
     "classifier STRING", "STRING", f"""
        concat({quoted(DOWNLOAD_COMMAND_PREFIX)}, group_id, ':', artifact_id, ':', version, ':', extension,
               coalesce(concat(':', classifier), ''))"""),
    ("content_key", "uinfo STRING", "BINARY", "unhex(md5(cast(uinfo AS BINARY)))"),
    ("stored_uinfo", "uinfo STRING", "STRING", f"left(uinfo, {UINFO_MAX_LEN})"),
    ("availability_code", "name STRING", "INT",
     "CASE name " + " ".join(f"WHEN {quoted(k)} THEN {v}" for k, v in AVAILABILITY_CODES.items()) + " END"),
    ("epoch_ms_to_datetime", "ms BIGINT", "TIMESTAMP_NTZ", f"""
        CASE WHEN ms BETWEEN 0 AND {MAX_DATETIME_MS}L
             THEN timestampadd(SECOND, ms div 1000 + CASE WHEN ms % 1000 >= 500 THEN 1 ELSE 0 END,
                               TIMESTAMP_NTZ '1970-01-01 00:00:00') END"""),
    ("is_stable_version", "v STRING", "BOOLEAN", "v IS NOT NULL AND NOT lower(v) RLIKE "
     + quoted("|".join(UNSTABLE_VERSION_WORDS))),
    ("json_elements", "doc STRING, path STRING", "ARRAY<VARIANT>", JSON_ELEMENTS.format(doc="doc", path="path")),
    ("json_has_rows", "doc STRING, path STRING", "BOOLEAN", "coalesce(size({f}json_elements(doc, path)) > 0, false)"),
)
# (name, parameters, columns, query). The rows come straight from the generator (a call of another SQL
# function cannot stand there), so a lateral call becomes a generator over the caller's rows, not a join.
TABLES = (
    ("json_table", "doc STRING, path STRING, columns MAP<STRING, STRING>",
     "rowid INT COMMENT 'from 1', cols MAP<STRING, STRING> COMMENT 'the columns, by their paths'", f"""
        SELECT cast(pos + 1 AS INT),
               transform_values(columns, (name, own) -> try_variant_get(col, own, 'string'))
        FROM posexplode({JSON_ELEMENTS.format(doc="doc", path="path")})"""),
)


def register_functions(spark: SparkSession, database: str | None = None) -> list[str]:
    """Create the functions in ``database``, or as temporary ones; returns the public names."""
    f = f"{database}." if database else ""
    kind = "" if database else "TEMPORARY "
    for name, parameters, returns, body in SCALARS:
        spark.sql(f"CREATE OR REPLACE {kind}FUNCTION {f}{name}({parameters}) RETURNS {returns} "
                  f"RETURN {body.replace('{f}', f)}")
    for name, parameters, columns, body in TABLES:
        spark.sql(f"CREATE OR REPLACE {kind}FUNCTION {f}{name}({parameters}) RETURNS TABLE ({columns}) "
                  f"RETURN {body.replace('{f}', f)}")
    return [n for n, *_ in (*SCALARS, *TABLES) if not n.startswith("_")]
