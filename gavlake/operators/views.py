"""The two views: newest-version name per artifact (JOIN-1) and stable downloadable
binaries (JOIN-2, FLT-4/5, PRJ-16..18).

Each view is defined once, as SQL over named inputs. The DataFrame functions run that text over
DataFrames, and ``plans.catalog`` declares it over a store's tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import (
    BINARY_CLASSIFIER,
    DEFAULT_EXTENSIONS,
    DOWNLOAD_COMMAND_PREFIX,
    LOCATION_TYPE,
    UNSTABLE_VERSION_WORDS,
)

# Largest extension table that is broadcast; a bigger one is joined with a shuffle.
MAX_BROADCAST_EXTENSIONS = 100_000


def quoted(text: str) -> str:
    """SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


# A null description is answered with the artifact id, as a null name is.
_NAMED = "coalesce(name, artifact_id) AS name, coalesce(description, artifact_id) AS description"
_NEWEST = "SELECT group_id, artifact_id, version_seq_max AS version_seq FROM {ga}"
#: Rows of ``ga`` that no file matches. In a store ``ga`` rolls up the same ``gav``, so its maxima are
#: some file's unless a part of the key is null; of a stale ``ga`` the keys are looked up.
_UNMATCHED = {
    True: "WHERE group_id IS NULL OR artifact_id IS NULL OR version_seq IS NULL",
    False: "LEFT ANTI JOIN (SELECT DISTINCT group_id, artifact_id, version_seq FROM {gav}) known "
           "USING (group_id, artifact_id, version_seq)",
}


def ga_latest_sql(rolled_up: bool) -> str:
    """SQL over ``{ga}`` and ``{gav}``; see ``ga_latest``."""
    return f"""
        WITH newest AS ({_NEWEST})
        SELECT group_id, artifact_id, {_NAMED}
        FROM newest JOIN (SELECT group_id, artifact_id, version_seq, name, description FROM {{gav}}) files
          USING (group_id, artifact_id, version_seq)
        UNION ALL
        SELECT group_id, artifact_id, artifact_id AS name, artifact_id AS description
        FROM newest {_UNMATCHED[rolled_up]}"""


def ga_latest(ga: DataFrame, gav: DataFrame, distinct: bool = False, rolled_up: bool = False) -> DataFrame:
    """``v_ga2ga``: every (group, artifact) with name and description of its newest files.

    All files of the newest version match, so an artifact can appear more than once
    (kept, as in the reference); ``distinct=True`` removes repeated rows.

    The left outer join is written as an inner equi-join plus the ``ga`` rows without a
    match. In a left outer join AQE can split only the preserved side, so a hot key on
    ``gav`` (one version with very many files) would stay in one task; an inner join
    lets AQE split the skewed side.

    ``rolled_up`` says that ``ga`` is the roll-up of this very ``gav``, which holds for a
    store, as its tables are swapped together; ``gav`` is then read once. Otherwise (a stale ``ga``)
    the unmatched rows come from an anti join against the *distinct* join keys of ``gav``, which
    partial aggregation reduces map-side.
    """
    out = ga.sparkSession.sql(ga_latest_sql(rolled_up), ga=ga, gav=gav)
    return out.distinct() if distinct else out


def extensions_are_small(extensions: DataFrame) -> bool:
    """Row count of an extension table checked against the broadcast bound (runs a job)."""
    return extensions.count() <= MAX_BROADCAST_EXTENSIONS


def extension_filter(df: DataFrame, extensions=DEFAULT_EXTENSIONS,
                     col: str = "file_extension", small_extensions: bool = False) -> DataFrame:
    """``col IN (extensions)``.

    A Python collection becomes an ``In`` predicate that reaches the Parquet scan.
    A DataFrame becomes a left semi join, planned by size; with ``small_extensions`` (see
    ``extensions_are_small``) its side is broadcast. No job runs here.
    """
    if isinstance(extensions, DataFrame):
        ext = extensions.select(F.col(extensions.columns[0]).alias("_ext")).distinct()
        right = F.broadcast(ext) if small_extensions else ext
        return df.join(right, F.col(col) == F.col("_ext"), "left_semi")
    return df.filter(F.col(col).isin(list(extensions)))


# Stable: a version, and none of the words in it. Binary: no classifier, or that of binaries.
STABLE = "artifact_version IS NOT NULL AND " + " AND ".join(
    f"NOT contains(lower(artifact_version), {quoted(w)})" for w in UNSTABLE_VERSION_WORDS)
BINARY = f"(classifier IS NULL OR classifier = {quoted(BINARY_CLASSIFIER)})"
# concat_ws leaves out a missing classifier, but must not leave out another missing part
_LOCATION = (f"CASE WHEN group_id IS NOT NULL AND artifact_id IS NOT NULL AND file_extension IS NOT NULL "
             f"THEN concat({quoted(DOWNLOAD_COMMAND_PREFIX)}, "
             f"concat_ws(':', group_id, artifact_id, artifact_version, file_extension, classifier)) END")
BINARY_COLUMNS = (
    "group_id", "artifact_id", "artifact_version", "major_version", "version_seq", "uinfo_md5 AS ref_md5",
    "last_modified AS mvn_last_modified", f"{LOCATION_TYPE} AS location_type", f"{_LOCATION} AS location",
    "size", "classifier", "file_extension", "packaging", "name", "description",
)


def stable_binaries_sql() -> str:
    """SQL over ``{gav}``; the files of allowed extensions are chosen by ``{allowed}``, a condition."""
    return f"SELECT {', '.join(BINARY_COLUMNS)} FROM {{gav}} WHERE {BINARY} AND {STABLE} AND {{allowed}}"


def stable_binaries(gav: DataFrame, extensions=DEFAULT_EXTENSIONS) -> DataFrame:
    """``v_artifactinfo2gav``: stable, downloadable binaries with a download command."""
    return (extension_filter(gav.filter(f"{BINARY} AND {STABLE}"), extensions).selectExpr(*BINARY_COLUMNS))
