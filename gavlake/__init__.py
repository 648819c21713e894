"""gavlake: artifact-index ETL and analytics on Spark DataFrames.

Main entry points:

* ``build_session`` - a session with the settings the package expects;
* ``read_index`` / ``raw_index`` - the raw index (from files, or derived from the test tables);
* ``TableStore`` - catalog tables of committed folders: append, write-then-swap overwrite, compact, vacuum;
* ``run_all`` / ``run_load`` / ``run_refresh`` - full load and derived-table refresh;
* ``run_increment`` - one increment of all tables, with roll-ups kept up to date;
* ``refresh`` / ``stream_audit`` - incremental load with Structured Streaming, and its audit;
* ``register_views`` / ``register_functions`` - tables, views and functions for ``spark.sql``;
* ``json_table`` / ``json_paths`` - JSON documents as rows, and their paths.
"""

from .functions.sql import register_functions
from .operators.json_docs import json_paths, json_table
from .plans.catalog import register_views
from .plans.etl import full_plan, run_all, run_increment, run_load, run_refresh
from .session import build_session
from .sinks.tables import TableStore
from .sources.fixture import raw_index
from .sources.index import read_index
from .streaming.incremental import refresh, stream_audit

__all__ = [
    "TableStore", "build_session", "full_plan", "json_paths", "json_table", "raw_index", "read_index", "refresh",
    "register_functions", "register_views", "run_all", "run_increment", "run_load", "run_refresh", "stream_audit",
]
