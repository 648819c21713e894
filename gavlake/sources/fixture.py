"""Index records derived from the driver's TPC-H-like tables (``lineitem JOIN part``).

The real input of the load is a table of decoded index documents (``raw_index``).
The test data carries none, so this module derives one, deterministically and at the
scale of ``lineitem``; the rules are listed in FIXTURES.md §2.

``doc_ord`` is the dense 1-based position of a row in the total order
``(l_orderkey, l_linenumber, l_partkey, l_suppkey, lastModified)``. It is computed
without a global single-partition window: rows are range-partitioned on the order key,
sorted within partitions, numbered by position inside their partition, and shifted by
the row count of all earlier partitions (a table with one row per partition).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import RAW_INDEX
from ..session import compilable, scratch_path

# Every lineitem row becomes one index document. The modulo expressions below only
# derive attributes of a document (deleted, not an artifact, version form, extension,
# ...), as FIXTURES.md §2 specifies; none of them selects a subset of the rows.

# Fixed values of the fixture rules (FIXTURES.md §2).
TOP_LEVEL_DOMAINS = ("org", "com", "io", "de", "cn")
SPECIAL_GROUP = "org.apache.tomcat"
SPECIAL_ARTIFACT = "tomcat"
RETURNFLAG_CLASSIFIER = {"R": "sources", "N": "bin"}
EXTENSION_BY_SUPPKEY = ("pom", "zip", "zip.sha512")  # suppkey % 5 = 0, 1, 2; else "jar"
BAD_CHECKSUM_SUFFIX = " bad-checksum"
REPOSITORY = "central"
# Records that break a declared limit or lack a value: l_orderkey % n = 0.
NO_GROUP, NO_ARTIFACT, NO_VERSION = 541, 547, 521
LONG_GROUP, LONG_ARTIFACT, LONG_VERSION = 571, 577, 523
LONG_CLASSIFIER, LONG_EXTENSION, LONG_PACKAGING, LONG_NAME = 509, 569, 563, 503
ORDER_COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "lastModified")

# Bit width of the in-partition position inside monotonically_increasing_id().
_MONO_ID_SHIFT = 33


def _group_id(p: dict[str, Column]) -> Column:
    brand = F.lower(F.replace(p["p_brand"], F.lit("#"), F.lit("")))
    tld = F.try_element_at(F.array(*[F.lit(t) for t in TOP_LEVEL_DOMAINS]),
                           (p["p_partkey"] % 6 + 1).cast("int"))
    type_part = F.when(p["p_size"] % 3 != 0, F.concat(F.lit("."), F.lower(p["p_type"]))
                       ).otherwise(F.lit(""))
    return (
        F.when(p["p_partkey"] % 50 == 0, F.lit(SPECIAL_GROUP))
        .when(p["p_partkey"] % 6 == 5, F.concat(F.lit("flat"), brand))
        .otherwise(F.concat(tld, F.lit("."), brand, type_part))
    )


def _version(l_orderkey: Column, n: Column, b: Column, s: Column) -> Column:
    def j(*parts):
        return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])

    forms = [
        j(n, ".", b, ".0"),
        j(n, ".", b),
        n,
        j(n, ".", b, ".", s),
        j("v", n),
        j((b.cast("int") + 2000).cast("string"), ".", n, ".7"),
        j("2015050", n),
        j("v20160422092", n),
        j(n, ".", b, "-SNAPSHOT"),
        j(n, ".", b, "-rc1"),
        j(n, ".", b, ".Final"),
        j(n, ".", b, "-beta-", s),
        F.lit("RELEASE"),
        j(n, ".", b, ".", s, ".4.5"),
        j("9223372036.999999.", s),
        j(n, ".", b, "-GA"),
    ]
    sel = l_orderkey % 16
    expr = None
    for i, form in enumerate(forms):
        expr = F.when(sel == i, form) if expr is None else expr.when(sel == i, form)
    return expr


def _epoch_ms() -> Column:
    return F.expr(
        "timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', "
        "cast(l_shipdate AS TIMESTAMP_NTZ))") + F.col("l_orderkey") % 1000


def join_inputs(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """The input columns of each record: lineitem joined with its part, plus
    ``lastModified`` (the last order column)."""
    li = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                         "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate")
    pa = part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    # part has one row per key; the equi-join is planned by size (AQE).
    return li.join(pa, li.l_partkey == pa.p_partkey, "inner").withColumn("lastModified", _epoch_ms())


def derive_records(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Index records (without ``doc_ord``) plus the order columns."""
    return record_columns(join_inputs(lineitem, part))


def record_columns(j: DataFrame) -> DataFrame:
    """Joined input columns -> index record columns (a row-wise projection)."""
    pa_cols = ("p_partkey", "p_name", "p_brand", "p_type", "p_size")

    p = {c: F.col(c) for c in pa_cols}
    n = F.col("l_linenumber").cast("string")
    b = F.col("l_quantity").cast("int").cast("string")
    s = F.col("l_suppkey").cast("string")
    okey = F.col("l_orderkey")

    group_id = _group_id(p)
    artifact_id = F.when(p["p_partkey"] % 50 == 0, F.lit(SPECIAL_ARTIFACT)).otherwise(
        F.replace(p["p_name"], F.lit(" "), F.lit("-")))
    classifier = F.when(F.col("l_returnflag") == "R", F.lit(RETURNFLAG_CLASSIFIER["R"])).when(
        F.col("l_returnflag") == "N", F.lit(RETURNFLAG_CLASSIFIER["N"]))
    ext_sel = F.col("l_suppkey") % 5
    file_ext = (F.when(ext_sel == 0, F.lit(EXTENSION_BY_SUPPKEY[0]))
                .when(ext_sel == 1, F.lit(EXTENSION_BY_SUPPKEY[1]))
                .when(ext_sel == 2, F.lit(EXTENSION_BY_SUPPKEY[2]))
                .otherwise(F.lit("jar")))
    version = _version(okey, n, b, s)
    every = lambda k: okey % k == 0
    none = F.lit(None).cast("string")
    filled = lambda c, k: F.repeat(F.lit(c), F.lit(k))
    group_id = F.when(every(NO_GROUP), none).when(every(LONG_GROUP), filled("g", 260)).otherwise(group_id)
    artifact_id = (F.when(every(NO_ARTIFACT), none).when(every(LONG_ARTIFACT), filled("a", 260))
                   .otherwise(artifact_id))
    version = (F.when(every(NO_VERSION), none)
               .when(every(LONG_VERSION), F.concat(version, filled(".1", 70))).otherwise(version))
    classifier = F.when(every(LONG_CLASSIFIER), filled("c", 130)).otherwise(classifier)
    file_ext = F.when(every(LONG_EXTENSION), filled("e", 260)).otherwise(file_ext)
    packaging = F.when(every(LONG_PACKAGING), filled("p", 260)).otherwise(file_ext)
    attributes = F.when(every(7), F.create_map(
        F.lit("Bundle-Version"), F.concat(n, F.lit(".0")), F.lit("note"), F.lit('a "quoted" value')))
    highlights = (F.when(okey % 13 == 0, F.array().cast("array<string>"))
                  .when(okey % 13 == 1, F.array(F.lit("h1"), n)))
    sha1 = F.sha1(okey.cast("string").cast("binary"))
    present = F.lit("PRESENT")
    not_present = F.lit("NOT_PRESENT")

    rec = j.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        (okey % 101 != 0).alias("is_live"),
        (okey % 211 != 0).alias("is_artifact"),
        group_id.alias("groupId"),
        artifact_id.alias("artifactId"),
        version.alias("version"),
        classifier.alias("classifier"),
        file_ext.alias("fileExtension"),
        packaging.alias("packaging"),
        F.when(every(LONG_NAME), filled("n", 1030)).when(p["p_partkey"] % 4 == 0, none)
        .otherwise(p["p_name"]).alias("name"),
        F.when(p["p_partkey"] % 3 == 0, none).otherwise(
            F.concat(p["p_name"], F.lit(' é "'), p["p_type"], F.lit('" \\'))).alias("description"),
        F.col("lastModified"),
        (okey * 1000 + F.col("l_linenumber")).alias("size"),
        F.when(okey % 997 == 0, F.concat(sha1, F.lit(BAD_CHECKSUM_SUFFIX))).otherwise(sha1
                                                                                     ).alias("sha1"),
        F.lit(REPOSITORY).alias("repository"),
        F.when(F.col("l_linestatus") == "F", present).otherwise(F.lit("NOT_AVAILABLE")
                                                               ).alias("sourcesExists"),
        F.when(F.col("l_linenumber") % 2 == 0, present).otherwise(not_present
                                                                 ).alias("javadocExists"),
        F.when(F.col("l_linenumber") % 3 == 0, present).otherwise(not_present
                                                                 ).alias("signatureExists"),
        attributes.alias("attributes"),
        F.when(every(11), F.lit("central-ctx")).alias("context"),
        highlights.alias("matchHighlights"),
    )
    return rec.withColumn(
        "uinfo",
        F.concat_ws("|", "groupId", "artifactId", "version",
                    F.coalesce(F.col("classifier"), F.lit("NA")), "fileExtension"),
    )


def dense_order(df: DataFrame, order_cols: list[str] | tuple[str, ...], out: str,
                num_partitions: int | None = None, project=None) -> DataFrame:
    """Add ``out`` = dense 1-based row position of each row in the order ``order_cols``.

    The order must be total (no ties), otherwise positions of tied rows are arbitrary.
    Rows are range-partitioned (``num_partitions`` tasks, or the session's shuffle
    partitions coalesced by AQE to its advisory size; range partitioning splits even a
    hot leading key, because the key is total), sorted within partitions and tagged
    with ``monotonically_increasing_id`` (partition index in the high bits, position
    in the low bits). That result is written once to the shared checkpoint
    folder: counts and positions must come from the same evaluation (a second
    evaluation could sample other range bounds). Only the per-partition counts are
    broadcast, one row per partition: bounded by the partition count.

    ``project`` (DataFrame -> DataFrame, row-wise) is applied after the sort, so costly
    columns are computed once, not also in the sampling pass of the range partitioner,
    and do not travel through the shuffle.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "dense_order")
    # Without an explicit count AQE may coalesce adjacent range partitions to its
    # advisory size; that keeps the order, and counts and positions are both taken
    # from the one written result.
    ranged = (df.repartitionByRange(num_partitions, *order_cols) if num_partitions
              else df.repartitionByRange(*order_cols))
    ordered = ranged.sortWithinPartitions(*order_cols)
    if project is not None:
        ordered = project(ordered)
    with compilable(spark):
        ordered.withColumn("_mono", F.monotonically_increasing_id()).write.parquet(path, compression="zstd")
    return read_ordered(spark, path, out)


def read_ordered(spark: SparkSession, path: str, out: str) -> DataFrame:
    """What ``dense_order`` wrote, with the positions."""
    numbered = (
        spark.read.parquet(path)
        .withColumn("_pid", F.shiftright("_mono", _MONO_ID_SHIFT))
        .withColumn("_pos", F.col("_mono") - F.shiftleft(F.col("_pid"), _MONO_ID_SHIFT))
    )
    counts = numbered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))
         ).alias("_off"),
    )
    return (
        numbered.join(F.broadcast(offsets), "_pid", "left")
        .withColumn(out, (F.coalesce(F.col("_off"), F.lit(0)) + F.col("_pos") + 1).cast("long"))
        .drop("_mono", "_pid", "_pos", "_off")
    )


def raw_index_from_tables(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """``raw_index`` (schema ``RAW_INDEX``) from the driver's lineitem and part tables."""
    ordered = dense_order(join_inputs(lineitem, part), list(ORDER_COLUMNS), "doc_ord",
                          project=record_columns)
    return _as_index(ordered)


def _as_index(ordered: DataFrame) -> DataFrame:
    return ordered.select(*[F.col(f.name).cast(f.dataType) for f in RAW_INDEX.fields])


# Raw index written before, per application and data folder, so that queries share it.
_WRITTEN: dict[tuple[str, str], DataFrame] = {}


def raw_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw index of a data folder; it is derived and written once per application.

    It is read by the settings of ``spark``: what another session wrote is opened anew.
    """
    known = (spark.sparkContext.applicationId, sf_dir)
    df = _WRITTEN.get(known)
    if df is None or not _readable(df):
        lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
        part = spark.read.parquet(f"{sf_dir}/part.parquet")
        df = _WRITTEN[known] = raw_index_from_tables(lineitem, part)
    elif df.sparkSession is not spark:
        return _as_index(read_ordered(spark, df.inputFiles()[0].rsplit("/", 1)[0], "doc_ord"))
    return df


def index_size(spark: SparkSession, sf_dir: str) -> int:
    """Number of documents of the raw index, at most (Parquet keeps it in the files' footers)."""
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()


def _readable(df: DataFrame) -> bool:
    """Whether the files below ``df`` are still there (a scratch folder may be cleared)."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(df.inputFiles()[0])
    return path.getFileSystem(conf).exists(path)
