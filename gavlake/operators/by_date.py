"""A copy of ``gav`` by time, for the "recent" queries (FLT-6, AGG-3/4).

``gav`` is laid out by coordinates, so a time range touches every file. This copy has only the columns
of those queries, a part for each year, and files of narrow time ranges within it: a query opens the
parts of its years (the store knows them without listing folders), and there the Parquet
statistics skip what is older than its bound. A hot year is cut into ranges like any other.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sinks.tables import PART, TableStore

NAME = "gav_by_date"
COLUMNS = ("uinfo_md5", "group_id", "artifact_id", "classifier", "file_extension", "last_modified")
# Part of files without a date.
NO_DATE = -1


def write_by_date(gav: DataFrame, store: TableStore, mode: str) -> tuple[dict, int]:
    """Change that replaces the copy with ``gav``, or adds to it."""
    rows = gav.select(*COLUMNS, F.coalesce(F.year("last_modified"), F.lit(NO_DATE)).cast("int").alias(PART))
    return store.write_parts(rows, NAME, mode, ranges=["last_modified", "uinfo_md5"])


def since(store: TableStore, bound: dt.datetime) -> DataFrame:
    """Files modified after ``bound``."""
    years = [p for p in store.parts(NAME) if p >= bound.year]
    rows = store.table(NAME, years)
    return rows.filter(F.col("last_modified") > F.lit(bound.isoformat(sep=" ")).cast("timestamp_ntz"))
