"""Index records -> ``artifactinfo`` rows; first-wins dedup; skip-if-stored (PRJ-1,7-10,
DIST-1, JOIN-4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import availability_code, content_key, truncate_uinfo
from ..functions.version import with_version_key
from ..schemas import ARTIFACTINFO, RECORD_FIELDS
from ..session import remove, settings, written_once

KEY = "uinfo_md5"


def with_content_key(records: DataFrame) -> DataFrame:
    return records.withColumn(KEY, content_key("uinfo"))


def first_wins_dedup(records: DataFrame, key: str = KEY, order: str = "doc_ord") -> DataFrame:
    """One row per ``key``: the one with the smallest ``order`` (DIST-1).

    Planned as ``row_number() = 1``: Spark inserts a partial WindowGroupLimit before
    the shuffle, so each map task forwards at most one row per key; a key held by a
    third of all rows costs one row per map task in the shuffle, not a third of the data.
    """
    w = Window.partitionBy(key).orderBy(F.col(order).asc())
    return (records.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") == 1).drop("_rn"))


# Positions that one row of marks holds a bit of, as a power of two, and longs that these are.
SLICE_BITS = 9
WORDS = 1 << SLICE_BITS - 6
# Largest number of such rows that are broadcast: about 100 bytes each, so 2M of them (a billion positions) stay near 200 MB.
MAX_BROADCAST_SLICES = 2_000_000


def _slice(order: str) -> F.Column:
    return F.shiftright(F.col(order), SLICE_BITS)


def first_positions(records: DataFrame, stored: tuple[DataFrame, ...] = (), key: str = KEY, order: str = "doc_ord"
                    ) -> tuple[DataFrame, str, int] | None:
    """Marks of the positions of the records that are first of their key and whose key none of ``stored`` has
    (DIST-1, JOIN-4), the folder that they are written to (see ``remove``) and their number.

    Only keys and positions are shuffled, first reduced map-side to one row a key, so a hot key costs one row per map
    task. A bit a position is kept. None if positions don't tell the records apart: one is missing, two records that
    may be kept or dropped share one, or there are more marks than are ever broadcast. ``records`` is read twice, so its
    source must give the same rows each time.
    """
    seen, marked = Observation(), Observation()
    narrow = records.select(key, order).observe(seen, F.count_if(F.col(order).isNull()).alias("missing"))
    firsts = narrow.groupBy(key).agg(F.min(order).alias(order))
    for keys in stored:
        firsts = firsts.join(keys.select(key), key, "left_anti")
    firsts = firsts.select(order).observe(marked, F.count(F.lit(1)).alias("n"))
    word, bit = f"shiftright({order}, 6) & {WORDS - 1}", f"shiftleft(1L, cast({order} & 63 AS int))"
    words = F.array(*[F.coalesce(F.expr(f"bit_or({bit}) FILTER (WHERE ({word}) = {i})"), F.lit(0)) for i in range(WORDS)])
    marks, path = written_once(
        firsts.repartition(_slice(order)).groupBy(_slice(order).alias("_slice")).agg(words.alias("_words")), "positions")
    # each marked position is that of one record, and of one only
    bits = F.aggregate("_words", F.lit(0), lambda n, w: n + F.bit_count(w))
    slices, n_bits = marks.agg(F.count(F.lit(1)), F.coalesce(F.sum(bits), F.lit(0))).first()
    n = marked.get["n"]
    if (seen.get["missing"] == 0 and n_bits == n and slices <= MAX_BROADCAST_SLICES
            and at_positions(records.select(order), marks, order).count() == n):
        return marks, path, n
    remove(records.sparkSession, path)
    return None


def at_positions(records: DataFrame, marks: DataFrame, order: str = "doc_ord") -> DataFrame:
    """The records at marked positions; they are filtered where they are, not shuffled."""
    bit = F.getbit(F.get("_words", F.expr(f"cast(shiftright({order}, 6) & {WORDS - 1} AS int)")),
                   F.expr(f"cast({order} & 63 AS int)"))
    return records.join(F.broadcast(marks), (_slice(order) == F.col("_slice")) & (bit == 1), "left_semi")


# Largest number of batch rows whose keys are broadcast to filter the store. A 16-byte key
# costs about 50 bytes in a broadcast hash relation, so 2M keys stay near 100 MB, which a
# default driver can build. Bigger batches take the hash-partitioned anti join (same result).
MAX_BROADCAST_KEYS = 2_000_000


# Largest number of batch keys that are looked up in the store as literals of a filter. They pass
# through the driver: 16 bytes each.
MAX_LOOKUP_KEYS = 1_000


def stored_among(store_keys: DataFrame, keys: list[bytes], key: str = KEY) -> list[bytes]:
    """Those of a few ``keys`` that the store holds (JOIN-4, FLT-1).

    The keys are literals, so they select buckets, and in their files row groups by the statistics
    and Bloom filters of the key: of keys that are all new, next to nothing is read.
    """
    if len(keys) > MAX_LOOKUP_KEYS:
        raise ValueError(f"{len(keys)} keys are looked up, {MAX_LOOKUP_KEYS} at most can be")
    if not keys:
        return []
    wanted = store_keys.select(key).filter(F.col(key).isin([F.lit(bytearray(k)) for k in keys]))
    # a longer list is pushed down as its least and largest value only
    with settings(store_keys.sparkSession, {"spark.sql.parquet.pushdown.inFilterThreshold": str(MAX_LOOKUP_KEYS)}):
        return [bytes(r[0]) for r in wanted.distinct().collect()]


def batch_is_small(batch: DataFrame, limit: int | None = None) -> bool:
    """Row count of ``batch`` checked against ``limit`` (default: MAX_BROADCAST_KEYS).

    A plain count: every task counts its rows, and the single exchange carries one row per
    task. (A ``limit`` before the count would move the rows themselves into one task.)
    """
    return batch.count() <= (MAX_BROADCAST_KEYS if limit is None else limit)


def new_records(batch: DataFrame, store_keys: DataFrame, key: str = KEY,
                small_batch: bool = False, batch_keys: DataFrame | None = None) -> DataFrame:
    """Rows of ``batch`` whose key is not yet in the store (JOIN-4).

    Only the key column of the store is read. For a batch whose size was checked to be
    small (``small_batch``), the store's keys are filtered by a broadcast semi join with
    the batch keys (a scan, no shuffle of the growing store), and the few matches are
    broadcast to the anti join. Otherwise both sides are hash-partitioned on the key;
    MD5 keys spread evenly.
    """
    store = store_keys.select(key)
    if small_batch:
        bk = (batch_keys if batch_keys is not None else batch).select(key)
        existing = store.join(F.broadcast(bk), on=key, how="left_semi")
        return batch.join(F.broadcast(existing), on=key, how="left_anti")
    return batch.join(store, on=key, how="left_anti")


def record_json() -> F.Column:
    """The whole record as JSON; null fields are left out (PRJ-10)."""
    return F.to_json(F.struct(*[F.col(n) for n, _ in RECORD_FIELDS]))


def to_artifactinfo(records: DataFrame, fix_signature: bool = False) -> DataFrame:
    """Project index records (with ``uinfo_md5``) to the ``artifactinfo`` schema.

    ``fix_signature=False`` keeps the reference's behaviour of filling
    ``signature_exists`` from the sources flag.
    """
    signature_src = "signatureExists" if fix_signature else "sourcesExists"
    return with_version_key(records, "version").select(
        F.col(KEY),
        "major_version",
        "version_seq",
        F.length("uinfo").cast(T.IntegerType()).alias("uinfo_length"),
        F.coalesce(F.length("classifier"), F.lit(0)).cast(T.IntegerType()).alias("classifier_length"),
        availability_code(signature_src).alias("signature_exists"),
        availability_code("sourcesExists").alias("sources_exists"),
        availability_code("javadocExists").alias("javadoc_exists"),
        truncate_uinfo("uinfo").alias("uinfo"),
        record_json().alias("json"),
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to a declared schema (column order and types)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def artifactinfo_from_records(live: DataFrame, store_keys: DataFrame | None = None,
                              fix_signature: bool = False,
                              small_batch: bool | None = None) -> DataFrame:
    """Live index records -> new ``artifactinfo`` rows (dedup, skip stored, project).

    ``small_batch`` (checked here when not given) selects the broadcast path of the
    skip-stored step.
    """
    keyed = with_content_key(live)
    deduped = first_wins_dedup(keyed)
    if store_keys is not None:
        if small_batch is None:
            small_batch = batch_is_small(live)
        deduped = new_records(deduped, store_keys, small_batch=small_batch, batch_keys=keyed)
    return conform(to_artifactinfo(deduped, fix_signature=fix_signature), ARTIFACTINFO)
