"""Table schemas, declared limits and the fixed values the results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for equal results)
# ---------------------------------------------------------------------------

# Availability enum: name -> ordinal.
AVAILABILITY_CODES = {"NOT_PRESENT": 0, "PRESENT": 1, "NOT_AVAILABLE": 2}

# Stored coordinate strings are cut to this many characters.
UINFO_MAX_LEN = 250

# Stored checksums are cut to this many characters.
SHA1_MAX_LEN = 40

# Version words that mark a version as not stable (matched as lower-case substrings).
UNSTABLE_VERSION_WORDS = (
    "alpha", "beta", "build", "cr", "custom", "dev", "draft", "incubating", "m",
    "nightly", "post", "pre", "preview", "rc", "snapshot", "sp",
)

# Classifier accepted as a binary besides "no classifier".
BINARY_CLASSIFIER = "bin"

# Location type literal of the stable-binaries view.
LOCATION_TYPE = 2

# Command prefix of the download location.
DOWNLOAD_COMMAND_PREFIX = "mvn dependency:copy -U -DoutputDirectory=. -Dartifact="

# Known-bad index data: (group_id, artifact_id, wrong extension) -> right extension.
EXTENSION_FIXES = (("org.apache.tomcat", "tomcat", "zip.sha512", "zip"),)

# Default allowed extensions (the reference reads them from a table it does not define).
DEFAULT_EXTENSIONS = ("jar", "zip")

# Declared column limits: (table, column, max characters or None, not null).
COLUMN_LIMITS = (
    ("artifactinfo", "uinfo_md5", None, True),
    ("artifactinfo", "version_seq", None, True),
    ("artifactinfo", "uinfo", 254, True),
    ("gav", "uinfo", 254, True),
    ("gav", "group_id", 254, True),
    ("gav", "artifact_id", 254, True),
    ("gav", "artifact_version", 128, True),
    ("gav", "sha1", 40, False),
    ("gav", "classifier", 128, False),
    ("gav", "file_extension", 254, False),
    ("gav", "packaging", 254, False),
    ("gav", "name", 1024, False),
    ("gav", "uinfo_md5", None, True),
    ("gav", "version_seq", None, True),
)

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

# Fields of one decoded index record, in the order they are written to JSON.
RECORD_FIELDS = (
    ("groupId", T.StringType()),
    ("artifactId", T.StringType()),
    ("version", T.StringType()),
    ("classifier", T.StringType()),
    ("fileExtension", T.StringType()),
    ("packaging", T.StringType()),
    ("name", T.StringType()),
    ("description", T.StringType()),
    ("lastModified", T.LongType()),
    ("size", T.LongType()),
    ("sha1", T.StringType()),
    ("repository", T.StringType()),
    ("sourcesExists", T.StringType()),
    ("javadocExists", T.StringType()),
    ("signatureExists", T.StringType()),
    ("attributes", T.MapType(T.StringType(), T.StringType())),
    ("context", T.StringType()),
    ("matchHighlights", T.ArrayType(T.StringType())),
)

RAW_INDEX = T.StructType(
    [
        T.StructField("doc_ord", T.LongType(), False),
        T.StructField("is_live", T.BooleanType(), True),
        T.StructField("is_artifact", T.BooleanType(), True),
        T.StructField("uinfo", T.StringType(), True),
    ]
    + [T.StructField(n, t, True) for n, t in RECORD_FIELDS]
)

# Parsing schema for the stored JSON. Numbers are read as text and converted with
# try_cast, so quoted numbers ("123") are accepted like unquoted ones.
RECORD_JSON_READ = T.StructType(
    [T.StructField(n, T.StringType(), True) for n, _ in RECORD_FIELDS]
)

# The record fields the flattened table uses (the parse skips the others).
GAV_JSON_FIELDS = ("groupId", "artifactId", "version", "classifier", "fileExtension",
                   "packaging", "name", "description", "lastModified", "size", "sha1")
GAV_JSON_READ = T.StructType([f for f in RECORD_JSON_READ.fields if f.name in GAV_JSON_FIELDS])

ARTIFACTINFO = T.StructType([
    T.StructField("uinfo_md5", T.BinaryType(), False),
    T.StructField("major_version", T.IntegerType(), True),
    T.StructField("version_seq", T.LongType(), True),
    T.StructField("uinfo_length", T.IntegerType(), True),
    T.StructField("classifier_length", T.IntegerType(), True),
    T.StructField("signature_exists", T.IntegerType(), True),
    T.StructField("sources_exists", T.IntegerType(), True),
    T.StructField("javadoc_exists", T.IntegerType(), True),
    T.StructField("uinfo", T.StringType(), False),
    T.StructField("json", T.StringType(), True),
])

GAV = T.StructType([
    T.StructField("uinfo_md5", T.BinaryType(), False),
    T.StructField("uinfo_length", T.IntegerType(), True),
    T.StructField("uinfo", T.StringType(), False),
    T.StructField("group_id", T.StringType(), True),
    T.StructField("artifact_id", T.StringType(), True),
    T.StructField("artifact_version", T.StringType(), True),
    T.StructField("major_version", T.IntegerType(), True),
    T.StructField("version_seq", T.LongType(), True),
    T.StructField("last_modified", T.TimestampNTZType(), True),
    T.StructField("size", T.LongType(), True),
    T.StructField("sha1", T.StringType(), True),
    T.StructField("signature_exists", T.IntegerType(), True),
    T.StructField("sources_exists", T.IntegerType(), True),
    T.StructField("javadoc_exists", T.IntegerType(), True),
    T.StructField("classifier", T.StringType(), True),
    T.StructField("classifier_length", T.IntegerType(), True),
    T.StructField("file_extension", T.StringType(), True),
    T.StructField("packaging", T.StringType(), True),
    T.StructField("name", T.StringType(), True),
    T.StructField("description", T.StringType(), True),
])

_ROLLUP_COUNTERS = [
    T.StructField("artifact_version_counter", T.IntegerType(), True),
    T.StructField("major_version_counter", T.IntegerType(), True),
    T.StructField("version_seq_max", T.LongType(), True),
    T.StructField("last_modified_max", T.DateType(), True),
]

G = T.StructType(
    [T.StructField("group_id", T.StringType(), False)]
    + _ROLLUP_COUNTERS
    + [T.StructField(f"group_id_left{k}", T.StringType(), True) for k in range(1, 5)]
)

GA = T.StructType(
    [T.StructField("group_id", T.StringType(), False),
     T.StructField("artifact_id", T.StringType(), False)]
    + _ROLLUP_COUNTERS
)

TABLES = {"raw_index": RAW_INDEX, "artifactinfo": ARTIFACTINFO, "gav": GAV, "g": G, "ga": GA}

# Declared types of text columns: lengths that Spark checks when rows are inserted into a table. (The
# checksum is fixed at 40 characters there; a CHAR would come back padded, so it is a VARCHAR.)
DECLARED_TYPES = {(t, c): f"varchar({n})" for t, c, n, _ in COLUMN_LIMITS if n is not None} | {
    ("g", "group_id"): "varchar(254)", ("ga", "group_id"): "varchar(254)", ("ga", "artifact_id"): "varchar(254)"}


def column_type(table: str, field: T.StructField) -> str:
    """SQL type of a table's column."""
    return DECLARED_TYPES.get((table, field.name), field.dataType.simpleString())
