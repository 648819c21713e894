"""Coordinates that are equal but for trailing spaces, as one.

The reference's collation ignores trailing spaces in comparisons; Spark's default does not, but
``UTF8_BINARY_RTRIM`` does. Columns of that type join, group, sort and count distinct accordingly;
joins and aggregations stay hash-based, on the trimmed bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RTRIM = "UTF8_BINARY_RTRIM"
COORDINATES = ("group_id", "artifact_id", "artifact_version", "classifier", "file_extension")


def collated(df: DataFrame, columns=COORDINATES) -> DataFrame:
    """``df`` with those of ``columns`` that it has compared without trailing spaces; values stay."""
    return df.withColumns({c: F.collate(F.col(c), RTRIM) for c in columns if c in df.columns})


def plain(df: DataFrame, columns=COORDINATES) -> DataFrame:
    """Back to ordinary strings, without the trailing spaces: one spelling for each group."""
    return df.withColumns({c: F.rtrim(F.collate(F.col(c), "UTF8_BINARY")) for c in columns if c in df.columns})
