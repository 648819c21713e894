"""Document fingerprints by content-defined chunking.

A rolling gear hash over the UTF-8 bytes proposes boundaries; which bytes it has seen decides
them, not their position, so an insertion moves only the boundaries near it. Chunk sizes
are normalised: up to ``NORMAL`` bytes a strict mask must match, beyond it a loose one, and
no chunk is under ``LEAST`` (but a text's last) or over ``MOST``. A fingerprint is the set of chunk
digests with the chunks' lengths. The likeness of a document to another is the containment
weighted by length: the share of its distinct chunks' bytes that the other also has.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gavlake.llm.scratch import ship_by_value, shuffle_partitions, small_batches
from gavlake.llm.text import SpanHasher, mix, text_slices

LEAST, NORMAL, MOST = 12, 32, 128
STRICT, LOOSE = 0x3F << 20, 0x7 << 20
#: Ranges of doc_id per shuffle partition, within which a document finds its neighbour.
RANGES = 4


def _gear(raw):
    """Gear hash at each byte, over the last 32 bytes: h = 2 h + value, in five doublings."""
    values = (mix(np.arange(1, 257, dtype=np.uint64)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    h = values[raw]
    for shift in (1, 2, 4, 8, 16):
        older = h[:-shift] << np.uint32(shift)
        h = h.copy()
        h[shift:] += older
    return h


def _cuts(raw, begins, stops):
    """Chunk starts and ends of all rows, and each row's first chunk."""
    starts: list[int] = []
    ends: list[int] = []
    first = [0]
    h = _gear(raw)
    loose = np.flatnonzero((h & np.uint32(LOOSE)) == 0)
    # a boundary lies behind the byte whose hash matches; the strict mask holds the loose one
    strict = (loose[(h[loose] & np.uint32(STRICT)) == 0] + 1).tolist()
    loose = (loose + 1).tolist()
    n_strict, n_loose = len(strict), len(loose)
    a = b = 0
    for at, end in zip(begins.tolist(), stops.tolist()):
        while at < end:
            cut = min(at + MOST, end)
            a = bisect_left(strict, at + LEAST, a)
            if a < n_strict and strict[a] < at + NORMAL and strict[a] < cut:
                cut = strict[a]
            else:
                b = bisect_left(loose, at + NORMAL, b)
                if b < n_loose and loose[b] < cut:
                    cut = loose[b]
            starts.append(at)
            ends.append(cut)
            at = cut
        first.append(len(starts))
    return np.array(starts, np.int64), np.array(ends, np.int64), first


def chunk_sets(column) -> list[dict[int, int]]:
    """Digest -> length of the distinct chunks of each text.

    32 zero bytes stand before each row, so that its hashes see nothing of its neighbours
    and equal texts have equal chunks.
    """
    out: list[dict[int, int]] = []
    hasher = SpanHasher()
    for _, raw, offsets in text_slices(column):
        n = len(offsets) - 1
        shift = 32 * np.arange(1, n + 1)
        wide = np.zeros(len(raw) + 32 * n, np.uint8)
        wide[np.arange(len(raw)) + np.repeat(shift, np.diff(offsets))] = raw
        starts, ends, first = _cuts(wide, offsets[:-1] + shift, offsets[1:] + shift)
        digests = hasher(wide, starts, ends).tolist()
        sizes = (ends - starts).tolist()
        for r in range(n):
            a, b = first[r], first[r + 1]
            out.append(dict(zip(digests[a:b], sizes[a:b])))
    return out


def containment(a: dict[int, int], b: dict[int, int]) -> float:
    """Share of a's bytes, by distinct chunks, that b also has; 1 if both are empty."""
    total = sum(a.values())
    if not total:
        return 0.0 if b else 1.0
    return sum(n for d, n in a.items() if d in b) / total


def as_text(chunks: dict[int, int]) -> str:
    """``digest:length`` by digest, hexadecimal digests; empty for an empty text."""
    return ",".join(f"{d:016x}:{n}" for d, n in sorted(chunks.items()))


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, edited) in descending doc_id, null last, ties by text; null texts empty.

    ``edited`` has the last half of the code points replaced by as many first ones (or all)
    of the next document; after the last comes the first. Documents are cut into ranges of
    doc_id, a number bound to the shuffle partitions, each sorted on its own. Each range's
    first row also goes to the range before it, so one shuffle moves the texts once.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n = RANGES * shuffle_partitions(spark)
    steps = [i / n for i in range(1, n)]
    cuts = np.array(sorted(set(rows.approxQuantile("doc_id", steps, 0.25 / n))), np.float64)

    @F.pandas_udf("int")
    def part(ids):  # 0 has the largest ids; null ids come after the smallest
        x = ids.to_numpy(dtype="float64", na_value=-np.inf)
        return ids.__class__(len(cuts) - np.searchsorted(cuts, x, "right").astype(np.int32))

    rows = rows.select(
        "doc_id", "text", part("doc_id").alias("part"),
        F.struct(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("i"),
                 F.col("doc_id").isNotNull().alias("known"),
                 F.xxhash64("text").alias("h")).alias("o"))
    turn = Window.orderBy("own")  # over one row per range, a bound number
    heads = rows.groupBy(F.col("part").alias("own")).agg(F.max("o").alias("head"))
    heads = heads.select("own", "head", F.coalesce(
        F.lag("own").over(turn), F.max("own").over(Window.partitionBy())).alias("to"))
    lent = (rows.join(F.broadcast(heads), (F.col("part") == F.col("own")) & (F.col("o") == F.col("head")))
            .dropDuplicates(["own"])
            .select("doc_id", "text", F.col("to").alias("part"), "o", F.lit(True).alias("lent")))
    down = Window.partitionBy("part").orderBy("lent", F.col("o").desc())
    moved = (rows.withColumn("lent", F.lit(False)).unionByName(lent)
             .withColumn("next", F.lead("text").over(down)).where("not lent"))
    half = F.floor(F.length("text") / 2).cast("int")
    keep = (F.length("text") - half).cast("int")
    return moved.select(
        "doc_id", "text", F.col("next"),
        F.concat(F.substring("text", 1, keep), F.substring(F.coalesce("next", F.lit("")), 1, half)).alias("edited"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text (see ``with_next``).

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next);
    null texts count as empty and have the empty fingerprint, which is like another empty
    one (1) and unlike any other (0). A lone document is its own next. Repeated rows each
    give a row. Other columns are not read.
    """
    schema = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double")
    rows = with_next(docs).select("doc_id", F.length("text").cast("bigint").alias("n_chars"),
                                  F.sha2("edited", 256).alias("edited_sha256"), "text", "next", "edited")

    def measure(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                own = chunk_sets(batch.column("text"))
                edited = chunk_sets(batch.column("edited"))
                # the next row mostly is the next document
                text, after = batch.column("text"), batch.column("next")
                n = batch.num_rows
                follows = [i + 1 < n and text[i + 1].as_py() == after[i].as_py() for i in range(n)]
                apart = [i for i in range(n) if not follows[i]]
                others = dict(zip(apart, chunk_sets(after.take(pa.array(apart, pa.int64())))))
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id"), batch.column("n_chars"), batch.column("edited_sha256"),
                    pa.array([as_text(x) for x in own], pa.string()),
                    pa.array([as_text(x) for x in edited], pa.string()),
                    pa.array([containment(a, b) for a, b in zip(own, edited)], pa.float64()),
                    pa.array([containment(a, own[i + 1] if follows[i] else others[i])
                              for i, a in enumerate(own)], pa.float64()),
                ], [f.split()[0] for f in schema.split(", ")])

    return rows.mapInArrow(measure, schema)


ship_by_value(__name__)
