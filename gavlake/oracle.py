"""DuckDB SQL for every registered query (the correctness oracle).

The SQL is an independent formulation: it derives the index records from ``lineitem``
and ``part`` with a plain global ``row_number()``, dedups with a window over the
coordinate string, and builds ``gav`` straight from the record fields rather than by
parsing the JSON. Binary keys are printed as lower-case hex (``md5()``).
"""

from __future__ import annotations

from .schemas import (
    AVAILABILITY_CODES,
    COLUMN_LIMITS,
    DEFAULT_EXTENSIONS,
    DOWNLOAD_COMMAND_PREFIX,
    UNSTABLE_VERSION_WORDS,
)

AS_OF = "2000-01-01 00:00:00"
AS_OF_MINUS_1Y = "1999-01-01 00:00:00"
LOOKUP_GROUP, LOOKUP_ARTIFACT = "org.apache.tomcat", "tomcat"
LOOKUP_UINFO = "org.apache.tomcat|tomcat|RELEASE|NA|jar"
LOOKUP_MAJOR = 1


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in_list(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


def _shrink(x: str, k: int) -> str:
    return f"(CASE WHEN {x} > {10 ** k - 1} THEN CAST(left(CAST({x} AS VARCHAR), {k}) AS BIGINT) ELSE {x} END)"


def _code(x: str) -> str:
    arms = " ".join(f"WHEN {_q(k)} THEN {v}" for k, v in AVAILABILITY_CODES.items())
    return f"CAST(CASE {x} {arms} END AS INTEGER)"


_N = "CAST(l_linenumber AS VARCHAR)"
_B = "CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)"
_S = "CAST(l_suppkey AS VARCHAR)"
_VERSION_FORMS = [
    f"{_N} || '.' || {_B} || '.0'",
    f"{_N} || '.' || {_B}",
    f"{_N}",
    f"{_N} || '.' || {_B} || '.' || {_S}",
    f"'v' || {_N}",
    f"CAST(2000 + CAST(l_quantity AS INTEGER) AS VARCHAR) || '.' || {_N} || '.7'",
    f"'2015050' || {_N}",
    f"'v20160422092' || {_N}",
    f"{_N} || '.' || {_B} || '-SNAPSHOT'",
    f"{_N} || '.' || {_B} || '-rc1'",
    f"{_N} || '.' || {_B} || '.Final'",
    f"{_N} || '.' || {_B} || '-beta-' || {_S}",
    "'RELEASE'",
    f"{_N} || '.' || {_B} || '.' || {_S} || '.4.5'",
    f"'9223372036.999999.' || {_S}",
    f"{_N} || '.' || {_B} || '-GA'",
]

_BRAND = "lower(replace(p_brand, '#', ''))"

RAW_CTE = f"""
src AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    l_orderkey % 101 <> 0 AS is_live,
    l_orderkey % 211 <> 0 AS is_artifact,
    CASE WHEN l_orderkey % 541 = 0 THEN NULL WHEN l_orderkey % 571 = 0 THEN repeat('g', 260)
         WHEN p_partkey % 50 = 0 THEN 'org.apache.tomcat'
         WHEN p_partkey % 6 = 5 THEN 'flat' || {_BRAND}
         ELSE (['org', 'com', 'io', 'de', 'cn'])[p_partkey % 6 + 1] || '.' || {_BRAND}
              || CASE WHEN p_size % 3 <> 0 THEN '.' || lower(p_type) ELSE '' END
    END AS groupId,
    CASE WHEN l_orderkey % 547 = 0 THEN NULL WHEN l_orderkey % 577 = 0 THEN repeat('a', 260)
         WHEN p_partkey % 50 = 0 THEN 'tomcat' ELSE replace(p_name, ' ', '-') END AS artifactId,
    CASE WHEN l_orderkey % 521 = 0 THEN NULL
         ELSE CASE l_orderkey % 16 {' '.join(f'WHEN {i} THEN {f}' for i, f in enumerate(_VERSION_FORMS))} END
              || CASE WHEN l_orderkey % 523 = 0 THEN repeat('.1', 70) ELSE '' END END AS version,
    CASE WHEN l_orderkey % 509 = 0 THEN repeat('c', 130)
         WHEN l_returnflag = 'R' THEN 'sources' WHEN l_returnflag = 'N' THEN 'bin' END AS classifier,
    CASE WHEN l_orderkey % 569 = 0 THEN repeat('e', 260) WHEN l_suppkey % 5 = 0 THEN 'pom'
         WHEN l_suppkey % 5 = 1 THEN 'zip' WHEN l_suppkey % 5 = 2 THEN 'zip.sha512' ELSE 'jar' END AS fileExtension,
    CASE WHEN l_orderkey % 503 = 0 THEN repeat('n', 1030) WHEN p_partkey % 4 = 0 THEN NULL ELSE p_name END AS name,
    CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_name || ' é "' || p_type || '" \\' END AS description,
    CASE WHEN l_orderkey % 7 = 0 THEN
         '{{"Bundle-Version":"' || {_N} || '.0","note":"a \\"quoted\\" value"}}' END AS attributes,
    CASE WHEN l_orderkey % 11 = 0 THEN 'central-ctx' END AS context,
    CASE WHEN l_orderkey % 13 = 0 THEN '[]'
         WHEN l_orderkey % 13 = 1 THEN '["h1","' || {_N} || '"]' END AS matchHighlights,
    epoch_ms(l_shipdate) + l_orderkey % 1000 AS lastModified,
    l_orderkey * 1000 + l_linenumber AS size,
    sha1(CAST(l_orderkey AS VARCHAR)) || CASE WHEN l_orderkey % 997 = 0 THEN ' bad-checksum' ELSE '' END AS sha1,
    'central' AS repository,
    CASE WHEN l_linestatus = 'F' THEN 'PRESENT' ELSE 'NOT_AVAILABLE' END AS sourcesExists,
    CASE WHEN l_linenumber % 2 = 0 THEN 'PRESENT' ELSE 'NOT_PRESENT' END AS javadocExists,
    CASE WHEN l_linenumber % 3 = 0 THEN 'PRESENT' ELSE 'NOT_PRESENT' END AS signatureExists
  FROM lineitem JOIN part ON l_partkey = p_partkey
),
raw AS (
  SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, lastModified) AS doc_ord,
    is_live, is_artifact,
    concat_ws('|', groupId, artifactId, version, coalesce(classifier, 'NA'), fileExtension) AS uinfo,
    groupId, artifactId, version, classifier, fileExtension,
    CASE WHEN l_orderkey % 563 = 0 THEN repeat('p', 260) ELSE fileExtension END AS packaging, name,
    description, lastModified, size, sha1, repository, sourcesExists, javadocExists, signatureExists,
    attributes, context, matchHighlights
  FROM src
),
live AS (SELECT * FROM raw WHERE is_live AND is_artifact),
dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY uinfo ORDER BY doc_ord) AS rn FROM live)
  WHERE rn = 1
)"""

_JSON_FIELDS = [
    ("groupId", "s"), ("artifactId", "s"), ("version", "s"), ("classifier", "s"),
    ("fileExtension", "s"), ("packaging", "s"), ("name", "s"), ("description", "s"),
    ("lastModified", "n"), ("size", "n"), ("sha1", "s"), ("repository", "s"),
    ("sourcesExists", "s"), ("javadocExists", "s"), ("signatureExists", "s"),
    ("attributes", "j"), ("context", "s"), ("matchHighlights", "j"),
]


def _json_expr() -> str:
    parts = []
    for name, kind in _JSON_FIELDS:
        val = f"to_json({name})" if kind == "s" else f"CAST({name} AS VARCHAR)"
        parts.append(f"CASE WHEN {name} IS NOT NULL THEN '\"{name}\":' || {val} END")
    return "'{' || concat_ws(',', " + ", ".join(parts) + ") || '}'"


def _json_keys_expr() -> str:
    parts = [f"CASE WHEN {n} IS NOT NULL THEN '{n}' END" for n, _ in _JSON_FIELDS]
    return "concat_ws(',', " + ", ".join(parts) + ")"


VERSION_CTE = f"""
vtok AS (
  SELECT *, regexp_matches(version, '[^0-9]') AS has_dot,
         regexp_extract_all(version, '[0-9]+') AS toks
  FROM dedup
),
vnum AS (
  SELECT *,
    coalesce(TRY_CAST(toks[1] AS BIGINT), 0) AS t1,
    coalesce(TRY_CAST(toks[2] AS BIGINT), 0) AS t2,
    coalesce(TRY_CAST(toks[3] AS BIGINT), 0) AS t3,
    coalesce(TRY_CAST(toks[4] AS BIGINT), 0) AS t4,
    coalesce(TRY_CAST(version AS BIGINT), 0) AS whole
  FROM vtok
),
vshr AS (
  SELECT *,
    has_dot AND t1 >= 922 AS is_year,
    CASE WHEN t1 <= 9223372036 THEN t1
         WHEN CAST(left(CAST(t1 AS VARCHAR), 10) AS BIGINT) <= 9223372036
           THEN CAST(left(CAST(t1 AS VARCHAR), 10) AS BIGINT)
         ELSE CAST(left(CAST(t1 AS VARCHAR), 9) AS BIGINT) END AS head,
    {_shrink('t2', 6)} * 1000 + {_shrink('t3', 3)} AS rest
  FROM vnum
),
ver AS (
  SELECT *,
    CAST(CASE WHEN version IS NULL THEN NULL ELSE least(CASE WHEN is_year THEN coalesce(TRY_CAST(left(toks[1], 10) AS BIGINT), 0)
                    WHEN has_dot THEN t1 ELSE 0 END, 2147483647) END AS INTEGER) AS major_version,
    CASE WHEN version IS NULL THEN NULL WHEN is_year THEN
           CAST(CAST(head AS HUGEINT) * 1000000000 + rest
                - CASE WHEN CAST(head AS HUGEINT) * 1000000000 + rest > 9223372036854775807
                       THEN CAST('18446744073709551616' AS HUGEINT) ELSE 0 END AS BIGINT)
         WHEN has_dot THEN least(t1, 921) * 10000000000000000 + {_shrink('t2', 4)} * 1000000000000
                           + {_shrink('t3', 6)} * 1000000 + {_shrink('t4', 6)}
         ELSE {_shrink('whole', 6)} END AS version_seq
  FROM vshr
)"""

ARTIFACTINFO_CTE = f"""
artifactinfo AS (
  SELECT md5(uinfo) AS uinfo_md5, major_version, version_seq,
    CAST(length(uinfo) AS INTEGER) AS uinfo_length,
    CAST(coalesce(length(classifier), 0) AS INTEGER) AS classifier_length,
    {_code('sourcesExists')} AS signature_exists,
    {_code('sourcesExists')} AS sources_exists,
    {_code('javadocExists')} AS javadoc_exists,
    left(uinfo, 250) AS uinfo,
    {_json_expr()} AS json,
    {_json_keys_expr()} AS json_keys,
    sha1 AS json_sha1
  FROM ver
)"""

GAV_CTE = """
gav AS (
  SELECT md5(uinfo) AS uinfo_md5, CAST(length(uinfo) AS INTEGER) AS uinfo_length,
    left(uinfo, 250) AS uinfo,
    groupId AS group_id, artifactId AS artifact_id, version AS artifact_version,
    major_version, version_seq,
    CASE WHEN lastModified >= 0 AND lastModified <= 253402300799499
         THEN TIMESTAMP '1970-01-01 00:00:00' + to_seconds(CAST((lastModified + 500) // 1000 AS BIGINT))
    END AS last_modified,
    size, left(sha1, 40) AS sha1,
    {sig} AS signature_exists, {src} AS sources_exists, {jd} AS javadoc_exists,
    classifier, CAST(coalesce(length(classifier), 0) AS INTEGER) AS classifier_length,
    CASE WHEN groupId = 'org.apache.tomcat' AND artifactId = 'tomcat' AND fileExtension = 'zip.sha512'
         THEN 'zip' ELSE fileExtension END AS file_extension,
    packaging, name, description
  FROM ver
)""".format(sig=_code("sourcesExists"), src=_code("sourcesExists"), jd=_code("javadocExists"))

_ROLLUP_AGGS = """
    CAST(count(DISTINCT artifact_version) AS INTEGER) AS artifact_version_counter,
    CAST(count(DISTINCT major_version) AS INTEGER) AS major_version_counter,
    max(version_seq) AS version_seq_max,
    CAST(max(last_modified) AS DATE) AS last_modified_max"""


def _prefix(col: str, k: int) -> str:
    return f"array_to_string(string_split({col}, '.')[1:{k}], '.')"


def _limit_rules(table: str):
    return [(c, n, required) for t, c, n, required in COLUMN_LIMITS if t == table]


_BROKEN = " OR ".join(
    [f"{c} IS NULL" for c, _, required in _limit_rules("gav") if required]
    + [f"length({c}) > {n}" for c, n, _ in _limit_rules("gav") if n is not None])


def _rollups(gav: str, suffix: str) -> str:
    return f"""
g{suffix} AS (
  SELECT group_id, {_ROLLUP_AGGS},
    {', '.join(f"{_prefix('group_id', k)} AS group_id_left{k}" for k in range(1, 5))}
  FROM {gav} GROUP BY group_id
),
ga{suffix} AS (
  SELECT group_id, artifact_id, {_ROLLUP_AGGS}
  FROM {gav} GROUP BY group_id, artifact_id
)"""


# of all rows, and of the rows that a refresh in quarantine mode accepts
ROLLUP_CTE = f"""{_rollups('gav', '')},
gav_bad AS (SELECT * FROM gav WHERE coalesce({_BROKEN}, false)),
gav_ok AS (SELECT * FROM gav WHERE NOT coalesce({_BROKEN}, false)),
{_rollups('gav_ok', '_ok')}"""

_UNSTABLE = " AND ".join(f"lower(artifact_version) NOT LIKE '%{w}%'" for w in UNSTABLE_VERSION_WORDS)

def _views(suffix: str) -> str:
    return f"""
v_ga2ga{suffix} AS (
  SELECT ga.group_id, ga.artifact_id,
    coalesce(ai.name, ga.artifact_id) AS name,
    coalesce(ai.description, ga.artifact_id) AS description
  FROM ga{suffix} ga LEFT JOIN gav{suffix} ai
    ON ga.group_id = ai.group_id AND ga.artifact_id = ai.artifact_id
   AND ga.version_seq_max = ai.version_seq
),
v_artifactinfo2gav{suffix} AS (
  SELECT group_id, artifact_id, artifact_version, major_version, version_seq,
    uinfo_md5 AS ref_md5, last_modified AS mvn_last_modified, 2 AS location_type,
    {_q(DOWNLOAD_COMMAND_PREFIX)} ||
      CASE WHEN classifier IS NULL
           THEN group_id || ':' || artifact_id || ':' || artifact_version || ':' || file_extension
           ELSE group_id || ':' || artifact_id || ':' || artifact_version || ':' || file_extension || ':' || classifier
      END AS location,
    size, classifier, file_extension, packaging, name, description
  FROM gav{suffix}
  WHERE (classifier IS NULL OR classifier = 'bin')
    AND file_extension IN (SELECT extension FROM extension)
    AND artifact_version IS NOT NULL
    AND {_UNSTABLE}
)"""


VIEWS_CTE = f"""
extension AS (SELECT * FROM (VALUES {', '.join(f'({_q(e)})' for e in DEFAULT_EXTENSIONS)}) t(extension)),{_views('')},{_views('_ok')}"""

_ALL = ",".join([RAW_CTE, VERSION_CTE, ARTIFACTINFO_CTE, GAV_CTE, ROLLUP_CTE, VIEWS_CTE])


def _with(select: str) -> str:
    return f"WITH {_ALL}\n{select}"


AI_COLS = ("uinfo_md5, major_version, version_seq, uinfo_length, classifier_length, "
           "signature_exists, sources_exists, javadoc_exists, uinfo, json")
GAV_COLS = ("uinfo_md5, uinfo_length, uinfo, group_id, artifact_id, artifact_version, "
            "major_version, version_seq, last_modified, size, sha1, signature_exists, "
            "sources_exists, javadoc_exists, classifier, classifier_length, file_extension, "
            "packaging, name, description")
RAW_COLS = ("doc_ord, is_live, is_artifact, uinfo, groupId, artifactId, version, classifier, "
            "fileExtension, packaging, name, description, lastModified, size, sha1, repository, "
            "sourcesExists, javadocExists, signatureExists, attributes, context, matchHighlights")

# Declared columns and types of each object: fixed values.
_GAV_TYPES = ("uinfo_md5 binary, uinfo_length int, uinfo string, group_id string, artifact_id string, "
              "artifact_version string, major_version int, version_seq bigint, last_modified timestamp_ntz, "
              "size bigint, sha1 string, signature_exists int, sources_exists int, javadoc_exists int, "
              "classifier string, classifier_length int, file_extension string, packaging string, "
              "name string, description string")
_COUNTER_TYPES = ("artifact_version_counter int, major_version_counter int, version_seq_max bigint, "
                  "last_modified_max date")
OBJECTS = [
    ("artifactinfo", "artifactinfo", "uinfo_md5 binary, major_version int, version_seq bigint, uinfo_length int, "
     "classifier_length int, signature_exists int, sources_exists int, javadoc_exists int, uinfo string, json string"),
    ("gav", "gav_ok", _GAV_TYPES),
    ("g", "g_ok", f"group_id string, {_COUNTER_TYPES}, group_id_left1 string, group_id_left2 string, "
     "group_id_left3 string, group_id_left4 string"),
    ("ga", "ga_ok", f"group_id string, artifact_id string, {_COUNTER_TYPES}"),
    ("v_ga2ga", "v_ga2ga_ok", "group_id string, artifact_id string, name string, description string"),
    ("v_artifactinfo2gav", "v_artifactinfo2gav_ok", "group_id string, artifact_id string, artifact_version string, "
     "major_version int, version_seq bigint, ref_md5 binary, mvn_last_modified timestamp_ntz, location_type int, "
     "location string, size bigint, classifier string, file_extension string, packaging string, name string, "
     "description string"),
]


def _objects_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS object, '{c.split()[0]}' AS column_name, '{c.split()[1]}' AS data_type, "
        f"{i + 1} AS position, (SELECT count({c.split()[0]}) FROM {source}) AS n_values"
        for name, source, columns in OBJECTS for i, c in enumerate(columns.split(", ")))


def _revised(keys: str) -> str:
    return (f"SELECT {keys}, count(*) AS counter FROM gav WHERE classifier IS NULL "
            f"AND file_extension IN (SELECT extension FROM extension) "
            f"AND last_modified > TIMESTAMP '{AS_OF_MINUS_1Y}' GROUP BY {keys} "
            f"ORDER BY counter DESC, {keys}")


def _by_prefix(k: int, two_letter: bool = False) -> str:
    col = f"group_id_left{k}"
    where = f"WHERE strlen({col}) = 2" if two_letter else ""
    return (f"SELECT {col}, count(*) AS counter FROM "
            f"(SELECT {_prefix('group_id', k)} AS {col} FROM ga) {where} "
            f"GROUP BY {col} ORDER BY counter DESC, {col}")


def sql() -> dict[str, str]:
    """Query name -> DuckDB SQL."""
    ai_out = f"SELECT {AI_COLS} FROM artifactinfo"
    q = {
        # sources and sinks
        "index_scan": f"SELECT {RAW_COLS} FROM raw",
        "live_records": f"SELECT {RAW_COLS} FROM live",
        "incremental_refresh": ai_out,
        "table_reads": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS n_rows, count(DISTINCT {k}) AS n_keys FROM {source}"
            for t, source, k in (("artifactinfo", "artifactinfo", "uinfo_md5"), ("gav", "gav_ok", "uinfo_md5"),
                                 ("gav_rejects", "gav_bad", "uinfo_md5"), ("g", "g_ok", "group_id"),
                                 ("ga", "ga_ok", "group_id"))),
        "append_artifactinfo": (
            "SELECT uinfo_md5, CASE WHEN uinfo_md5 IN (SELECT md5(uinfo) FROM live "
            "WHERE doc_ord <= (SELECT max(doc_ord) FROM raw) // 2) THEN 1 ELSE 2 END AS run FROM artifactinfo"),
        "overwrite_gav": f"SELECT {GAV_COLS} FROM gav_ok",
        "overwrite_g": "SELECT * FROM g_ok",
        "overwrite_ga": "SELECT * FROM ga_ok",
        "gav_rejects": f"SELECT {GAV_COLS} FROM gav_bad",
        "declare_tables": _objects_sql(),
        "declared_types": _declared_types_sql(),
        "artifactinfo_rejects": f"{ai_out} WHERE version_seq IS NULL OR uinfo IS NULL OR length(uinfo) > 254",
        "stream_audit": """
            SELECT CAST(batch AS BIGINT) AS batch, count(*) AS scanned, CAST(0 AS BIGINT) AS corrupt,
                   count(*) FILTER (NOT is_live) AS deleted,
                   count(*) FILTER (is_live AND NOT is_artifact) AS not_artifact,
                   (SELECT count(*) FROM ver v WHERE version_seq IS NOT NULL AND uinfo IS NOT NULL
                      AND (v.doc_ord > (SELECT max(doc_ord) FROM raw) // 2) = (r.batch = 1)) AS stored,
                   (SELECT count(*) FROM ver v WHERE (version_seq IS NULL OR uinfo IS NULL)
                      AND (v.doc_ord > (SELECT max(doc_ord) FROM raw) // 2) = (r.batch = 1)) AS rejected
            FROM (SELECT *, CASE WHEN doc_ord > (SELECT max(doc_ord) FROM raw) // 2 THEN 1 ELSE 0 END AS batch
                  FROM raw) r GROUP BY r.batch""",
        "maintained_g": "SELECT * FROM g_ok",
        "maintained_ga": "SELECT * FROM ga_ok",
        "replayed_batch": ai_out,
        "drop_reasons": f"""
            SELECT 'scanned' AS reason, count(*) AS n FROM raw
            UNION ALL SELECT 'corrupt', count(*) FROM raw WHERE {_BROKEN_LINE}
            UNION ALL SELECT 'deleted', count(*) FROM raw WHERE NOT ({_BROKEN_LINE}) AND NOT is_live
            UNION ALL SELECT 'not_artifact', count(*) FROM raw
              WHERE NOT ({_BROKEN_LINE}) AND is_live AND NOT is_artifact""",
        "index_rejects": f"""
            SELECT CASE WHEN doc_ord % 37 = 0 THEN '{{"doc_ord":' || doc_ord || ',"uinfo":"cut'
                        ELSE '{{"doc_ord":"no ' || doc_ord || '","is_live":true}}' END AS line
            FROM raw WHERE {_BROKEN_LINE}""",
        "sql_views": (
            "SELECT n.group_id, n.artifact_id, n.name, count(*) AS files, max(b.version_seq) AS newest "
            "FROM (SELECT DISTINCT group_id, artifact_id, name FROM v_ga2ga_ok) n "
            "JOIN v_artifactinfo2gav_ok b ON n.group_id = b.group_id AND n.artifact_id = b.artifact_id "
            "GROUP BY n.group_id, n.artifact_id, n.name"),
        "export_json": "SELECT json FROM artifactinfo",
        # projections
        "content_key": "SELECT uinfo, uinfo_md5 FROM artifactinfo",
        "version_tokens": ("SELECT DISTINCT version, has_dot, toks[1] AS token1, toks[2] AS token2, "
                           "toks[3] AS token3, toks[4] AS token4 FROM vtok"),
        "safe_long": "SELECT DISTINCT version, t1, t2, t3, t4 FROM vnum",
        "shrink_long": (f"SELECT DISTINCT version, head AS first_shrunk, {_shrink('t2', 4)} AS minor_4, "
                        f"{_shrink('t2', 6)} AS minor_6, {_shrink('t3', 6)} AS incremental_6, "
                        f"{_shrink('t3', 3)} AS incremental_3, {_shrink('t4', 6)} AS fourth_6 FROM vshr"),
        "version_seq": "SELECT DISTINCT version, version_seq FROM ver",
        "major_version": "SELECT DISTINCT version, major_version FROM ver",
        "sql_functions": (
            f"SELECT DISTINCT version, major_version, version_seq, toks[1] AS token1, {_shrink('t2', 4)} AS minor_4, "
            f"coalesce(version IS NOT NULL AND {_UNSTABLE.replace('artifact_version', 'version')}, false) AS stable "
            "FROM ver"),
        "sql_functions_gav": (
            f"SELECT uinfo_md5, {_prefix('group_id', 2)} AS org, last_modified, javadoc_exists, "
            f"{_q(DOWNLOAD_COMMAND_PREFIX)} || group_id || ':' || artifact_id || ':' || artifact_version || ':' || "
            "raw_extension || coalesce(':' || classifier, '') AS command FROM gav JOIN "
            "(SELECT md5(uinfo) AS uinfo_md5, fileExtension AS raw_extension FROM ver) USING (uinfo_md5)"),
        "length_features": "SELECT uinfo_md5, uinfo_length, classifier_length FROM artifactinfo",
        "availability_codes": ("SELECT uinfo_md5, signature_exists, sources_exists, javadoc_exists "
                               "FROM artifactinfo"),
        "truncate_uinfo": "SELECT uinfo_md5, uinfo FROM artifactinfo",
        "to_json": "SELECT uinfo_md5, json FROM artifactinfo",
        "flatten_gav": f"SELECT {GAV_COLS} FROM gav",
        "epoch_ms_to_datetime": "SELECT uinfo_md5, last_modified FROM gav",
        "sha1_prefix": "SELECT uinfo_md5, sha1 FROM gav",
        "fix_known_bad": "SELECT uinfo_md5, uinfo, file_extension FROM gav",
        "group_prefixes": ("SELECT group_id, group_id_left1, group_id_left2, group_id_left3, "
                           "group_id_left4 FROM g"),
        "null_fallback": ("SELECT uinfo_md5, artifact_id, coalesce(name, artifact_id) AS name, "
                          "coalesce(description, artifact_id) AS description "
                          "FROM gav WHERE name IS NULL OR description IS NULL"),
        "download_command": "SELECT ref_md5, location FROM v_artifactinfo2gav",
        "constant_and_rename": ("SELECT ref_md5, mvn_last_modified, location_type "
                                "FROM v_artifactinfo2gav"),
        "hex_key": f"SELECT {AI_COLS}, upper(uinfo_md5) AS uinfo_md5_hex FROM artifactinfo",
        "byte_length": ("SELECT uinfo_md5, CAST(strlen(json_sha1) AS INTEGER) AS sha1_bytes "
                        "FROM artifactinfo"),
        "json_keys": ("SELECT uinfo_md5, json_keys FROM artifactinfo ORDER BY uinfo_md5 LIMIT 100"),
        "refresh_marker": (
            "SELECT * FROM (VALUES "
            "('load', 'artifactinfo', (SELECT count(*) FROM artifactinfo), "
            "(SELECT count(*) FROM raw) - (SELECT count(*) FROM live)), "
            "('refresh', 'gav', (SELECT count(*) FROM gav_ok), (SELECT count(*) FROM gav_bad)), "
            "('refresh', 'g', (SELECT count(*) FROM g_ok), 0), "
            "('refresh', 'ga', (SELECT count(*) FROM ga_ok), 0)) "
            "t(step, table_name, rows_written, rows_dropped)"),
        # filters
        "find_by_md5": f"{ai_out} WHERE uinfo_md5 = md5({_q(LOOKUP_UINFO)})",
        "find_by_major_version": f"{ai_out} WHERE major_version = {LOOKUP_MAJOR}",
        "coordinate_lookup": (f"SELECT {GAV_COLS} FROM gav WHERE group_id = {_q(LOOKUP_GROUP)} "
                              f"AND artifact_id = {_q(LOOKUP_ARTIFACT)} ORDER BY uinfo_md5 LIMIT 10"),
        "seek_page": (f"SELECT {GAV_COLS} FROM gav WHERE version_seq IS NOT NULL "
                      "ORDER BY version_seq, uinfo_md5 LIMIT 10 OFFSET 20"),
        "recent_by_date": _revised("group_id").replace("FROM gav ", "FROM gav_ok "),
        "stable_versions": (f"SELECT uinfo_md5, artifact_version FROM gav "
                            f"WHERE artifact_version IS NOT NULL AND {_UNSTABLE}"),
        "binary_classifier": ("SELECT uinfo_md5, classifier FROM gav "
                              "WHERE classifier IS NULL OR classifier = 'bin'"),
        "recent_within": ("SELECT uinfo_md5, last_modified FROM gav "
                          f"WHERE last_modified > TIMESTAMP '{AS_OF_MINUS_1Y}'"),
        "country_codes": "SELECT group_id, group_id_left1 FROM g WHERE strlen(group_id_left1) = 2",
        "bad_checksums": (f"SELECT {AI_COLS}, upper(uinfo_md5) AS uinfo_md5_hex FROM artifactinfo "
                          "WHERE strlen(json_sha1) > 40"),
        "length_violations": _length_violations_sql(),
        # joins
        "ga_latest": "SELECT * FROM v_ga2ga",
        "stable_binaries": "SELECT * FROM v_artifactinfo2gav",
        "semi_in_samples": _revised("group_id, artifact_id"),
        "new_records": (
            "SELECT md5(uinfo) AS uinfo_md5, uinfo FROM dedup WHERE md5(uinfo) NOT IN ("
            "SELECT md5(uinfo) FROM live WHERE doc_ord <= (SELECT max(doc_ord) FROM raw) // 2)"),
        "new_records_small_batch": (
            "SELECT md5(uinfo) AS uinfo_md5, uinfo FROM dedup WHERE md5(uinfo) NOT IN ("
            "SELECT md5(uinfo) FROM live WHERE doc_ord <= (SELECT max(doc_ord) FROM raw) // 2)"),
        "new_records_lookup": (
            "SELECT uinfo_md5, CASE WHEN uinfo_md5 IN (SELECT md5(uinfo) FROM live "
            "WHERE doc_ord <= (SELECT max(doc_ord) FROM raw) - 500) THEN 1 ELSE 2 END AS run FROM artifactinfo"),
        "json_key_lateral": ("SELECT uinfo_md5, unnest(string_split(json_keys, ',')) AS json_key "
                             "FROM artifactinfo"),
        "json_rows_lateral": f"SELECT uinfo_md5, rowid, value AS groupId FROM ({_json_rows()}) "
                             "ORDER BY uinfo_md5, rowid LIMIT 100",
        "json_table_sql": (
            f"SELECT uinfo_md5, '$' AS path, rowid, value, note FROM ({_json_rows()}) UNION ALL "
            "SELECT uinfo_md5, '$.matchHighlights', CAST(generate_subscripts(h, 1) AS INTEGER), unnest(h), NULL "
            "FROM (SELECT md5(uinfo) AS uinfo_md5, from_json(matchHighlights, '[\"VARCHAR\"]') AS h FROM ver "
            "WHERE matchHighlights IS NOT NULL AND length(uinfo) % 7 NOT IN (1, 2, 3, 4, 5) AND length(uinfo) % 3 <> 0)"),
        "json_paths": (
            "SELECT regexp_replace(replace(t.fullkey, '\"', ''), '\\[[0-9]+\\]', '[*]', 'g') AS path, "
            "CASE t.type WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'VARCHAR' THEN 'STRING' ELSE t.type END AS type, "
            "count(*) AS n_values FROM artifactinfo, json_tree(artifactinfo.json) t GROUP BY ALL"),
        # aggregations
        "group_rollup": "SELECT * FROM g",
        "group_artifact_rollup": "SELECT * FROM ga",
        "collated_rollup": f"SELECT group_id, artifact_id, {_ROLLUP_AGGS} FROM gav GROUP BY group_id, artifact_id",
        "collated_latest": "SELECT * FROM v_ga2ga",
        "most_revised_groups": _revised("group_id"),
        "most_revised_artifacts": _revised("group_id, artifact_id"),
        "artifacts_by_country": _by_prefix(1, two_letter=True),
        "artifacts_by_org": _by_prefix(2),
        "artifacts_by_top_level": _by_prefix(1),
        "max_checksum_length": ("SELECT CAST(max(strlen(json_sha1)) AS INTEGER) AS max_sha1_length "
                                "FROM artifactinfo"),
        "first_wins_dedup": "SELECT md5(uinfo) AS uinfo_md5, doc_ord FROM dedup",
        "distinct_json_keys": ("SELECT DISTINCT unnest(string_split(json_keys, ',')) AS json_key "
                               "FROM artifactinfo ORDER BY json_key"),
        "limit_n": f"SELECT {GAV_COLS} FROM gav ORDER BY uinfo_md5 LIMIT 10",
    }
    return {k: _with(v) for k, v in q.items()}


# Lines of the index that do not decode, in the queries that write some.
_BROKEN_LINE = "doc_ord % 37 = 0 OR doc_ord % 41 = 0"


def _json_rows() -> str:
    """Rows of the documents of every kind: (uinfo_md5, rowid, value, note)."""
    plain = "length(uinfo) % 7 NOT IN (1, 2, 3, 4, 5)"
    odd = "length(uinfo) % 7 = 5"
    return f"""
        SELECT md5(uinfo) AS uinfo_md5, CAST(1 AS INTEGER) AS rowid, groupId AS value,
               CASE WHEN attributes IS NOT NULL THEN 'a "quoted" value' END AS note FROM ver WHERE {plain}
        UNION ALL SELECT md5(uinfo), 2, 'second', NULL FROM ver WHERE {plain} AND length(uinfo) % 3 = 0
        UNION ALL SELECT md5(uinfo), 1, NULL, NULL FROM ver WHERE {odd}
        UNION ALL SELECT md5(uinfo), 2, 'second', NULL FROM ver WHERE {odd}
        UNION ALL SELECT md5(uinfo), 3, NULL, NULL FROM ver WHERE {odd}"""


# Declared lengths of text columns; the others are strings of any length: fixed values.
_DECLARED = {
    "artifactinfo": {"uinfo": 254},
    "gav": {"uinfo": 254, "group_id": 254, "artifact_id": 254, "artifact_version": 128, "sha1": 40,
            "classifier": 128, "file_extension": 254, "packaging": 254, "name": 1024},
    "g": {"group_id": 254},
    "ga": {"group_id": 254, "artifact_id": 254},
}


def _declared_types_sql() -> str:
    arms = []
    for name, source, columns in OBJECTS:
        for column, kind in (c.split() for c in columns.split(", ")):
            if kind != "string" or name not in _DECLARED:
                continue
            n = _DECLARED[name].get(column)
            declared = f"varchar({n})" if n else "string"
            arms.append(f"SELECT '{name}' AS object, '{column}' AS column_name, '{declared}' AS declared, "
                        f"CAST(max(length({column})) AS INTEGER) AS longest FROM {source}")
    return " UNION ALL ".join(arms)


def _length_violations_sql() -> str:
    arms = []
    for table, col, max_len, not_null in COLUMN_LIMITS:
        if not_null:
            arms.append(f"SELECT uinfo_md5, '{table}' AS table_name, '{col}' AS column_name, "
                        f"'not_null' AS rule, CAST(NULL AS INTEGER) AS actual_length "
                        f"FROM {table} WHERE {col} IS NULL")
        if max_len is not None:
            arms.append(f"SELECT uinfo_md5, '{table}' AS table_name, '{col}' AS column_name, "
                        f"'max_length_{max_len}' AS rule, "
                        f"CAST(length({col}) AS INTEGER) AS actual_length FROM {table} WHERE length({col}) > {max_len}")
    return " UNION ALL ".join(arms)
