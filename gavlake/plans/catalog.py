"""SQL access: the stored tables and the two views as temp views (SNK-3), so the
reference's SQL (views and sample queries) can run with ``spark.sql``."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..functions.sql import register_functions
from ..operators.views import ga_latest, ga_latest_sql, stable_binaries, stable_binaries_sql
from ..schemas import DEFAULT_EXTENSIONS
from ..sinks.tables import TableStore

# Sample analysis queries in Spark SQL over the registered views. ``:as_of`` is a
# named parameter (the reference uses NOW()).
SAMPLE_SQL = {
    "most_revised_groups": """
        SELECT group_id, count(*) AS counter FROM gav
        WHERE classifier IS NULL
          AND file_extension IN (SELECT extension FROM extension)
          AND last_modified > CAST(:as_of AS TIMESTAMP_NTZ) - INTERVAL 1 YEAR
        GROUP BY group_id ORDER BY counter DESC, group_id""",
    "most_revised_artifacts": """
        SELECT group_id, artifact_id, count(*) AS counter FROM gav
        WHERE classifier IS NULL
          AND file_extension IN (SELECT extension FROM extension)
          AND last_modified > CAST(:as_of AS TIMESTAMP_NTZ) - INTERVAL 1 YEAR
        GROUP BY group_id, artifact_id ORDER BY counter DESC, group_id, artifact_id""",
    "artifacts_by_country": """
        SELECT group_id_left1, count(*) AS counter
        FROM (SELECT substring_index(group_id, '.', 1) AS group_id_left1 FROM ga)
        WHERE octet_length(group_id_left1) = 2
        GROUP BY group_id_left1 ORDER BY counter DESC, group_id_left1""",
    "artifacts_by_org": """
        SELECT group_id_left2, count(*) AS counter
        FROM (SELECT substring_index(group_id, '.', 2) AS group_id_left2 FROM ga)
        GROUP BY group_id_left2 ORDER BY counter DESC, group_id_left2""",
    "artifacts_by_top_level": """
        SELECT group_id_left1, count(*) AS counter
        FROM (SELECT substring_index(group_id, '.', 1) AS group_id_left1 FROM ga)
        GROUP BY group_id_left1 ORDER BY counter DESC, group_id_left1""",
    "distinct_json_keys": """
        SELECT DISTINCT json_key FROM artifactinfo
        LATERAL VIEW explode(json_object_keys(json)) t AS json_key
        ORDER BY json_key""",
    "max_checksum_length": """
        SELECT CAST(max(octet_length(get_json_object(json, '$.sha1'))) AS INT) AS max_sha1_length
        FROM artifactinfo""",
    "bad_checksums": """
        SELECT *, hex(uinfo_md5) AS uinfo_md5_hex FROM artifactinfo
        WHERE octet_length(get_json_object(json, '$.sha1')) > 40""",
    "json_keys": """
        SELECT uinfo_md5, json_object_keys(json) AS json_keys
        FROM (SELECT uinfo_md5, json FROM artifactinfo ORDER BY uinfo_md5 LIMIT 100)""",
    "json_rows_lateral": """
        SELECT uinfo_md5, t.rowid, t.cols['groupId'] AS groupId
        FROM (SELECT uinfo_md5, json FROM artifactinfo WHERE json_has_rows(json, '$')
              ORDER BY uinfo_md5 LIMIT 100) page,
             LATERAL json_table(page.json, '$', map('groupId', '$.groupId')) t
        ORDER BY uinfo_md5, rowid LIMIT 100""",
    "hex_key": """
        SELECT *, hex(uinfo_md5) AS uinfo_md5_hex FROM artifactinfo""",
}

def declare_views(spark: SparkSession, store: TableStore, extensions=DEFAULT_EXTENSIONS) -> None:
    """Create the two views, and the extension table that one reads, in the store's database (SNK-3).

    They are catalog objects over the store's tables, so they follow every swap.
    """
    if not store.exists("extension"):
        store.overwrite(spark.createDataFrame([(e,) for e in extensions], "extension string"), "extension")
    names = {n: store.qualified(n) for n in ("ga", "gav", "extension")}
    allowed = f"file_extension IN (SELECT extension FROM {names['extension']})"
    for name, sql in (("v_ga2ga", ga_latest_sql(rolled_up=True)), ("v_artifactinfo2gav", stable_binaries_sql())):
        spark.sql(f"CREATE OR REPLACE VIEW {store.qualified(name)} AS {sql.format(**names, allowed=allowed)}")


def register_views(spark: SparkSession, store: TableStore, extensions=DEFAULT_EXTENSIONS,
                   prefix: str = "") -> list[str]:
    """Create temp views ``artifactinfo``, ``gav``, ``g``, ``ga``, ``extension``,
    ``v_ga2ga`` and ``v_artifactinfo2gav`` (names optionally prefixed)."""
    register_functions(spark)
    names = []
    for name in ("artifactinfo", "gav", "g", "ga"):
        if store.exists(name):
            store.table(name).createOrReplaceTempView(prefix + name)
            names.append(prefix + name)
    spark.createDataFrame([(e,) for e in extensions], "extension string") \
        .createOrReplaceTempView(prefix + "extension")
    names.append(prefix + "extension")
    if store.exists("gav") and store.exists("ga"):
        gav, ga = store.table("gav"), store.table("ga")
        ga_latest(ga, gav, rolled_up=True).createOrReplaceTempView(prefix + "v_ga2ga")
        stable_binaries(gav, extensions).createOrReplaceTempView(prefix + "v_artifactinfo2gav")
        names += [prefix + "v_ga2ga", prefix + "v_artifactinfo2gav"]
    return names


def run_sample(spark: SparkSession, name: str, as_of: str = "2000-01-01 00:00:00"):
    """Run one of ``SAMPLE_SQL`` over the registered views."""
    sql = SAMPLE_SQL[name]
    return spark.sql(sql, args={"as_of": as_of}) if ":as_of" in sql else spark.sql(sql)
