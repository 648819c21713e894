"""N-gram Jaccard join by vertical partitioning.

A document's set holds the hashes of its distinct 5-word shingles. The global order of
n-grams is cut into fragments; every fragment counts its part of an overlap on its own, and
the parts are summed. The sums decide three things, each exactly:

1. **Which sets can link at all.** Of a set of n n-grams, a partner at similarity t holds at
   least ceil(t n). So among the smallest n-grams of both there are common ones (prefix
   filter); fragments count, per set, the n-grams of an extended prefix that any other set
   also has there. Then they count over whole sets, for the sets that are left. A set whose
   sum is too small links with nothing.
2. **Candidates.** N-grams are ordered by frequency among the sets that are left, rare ones
   first, and two linking sets share one of their first n - ceil(t n) + 1. Sets that share
   such an n-gram are compared with a few leaders of its group, not with each other: those
   with the fewest n-grams of their own, which are nearest to most. Links with leaders join
   nearly all of a large group; only pairs that are still in different components, and that
   sizes and positions allow to link, are then compared. So a group of k near copies costs
   about 8 k pairs, not k².
3. **Links.** Fragments count the overlap of a pair's segments, and the sums give the exact
   similarity.

Sets are 64-bit hashes of n-grams, and a set's name is a 64-bit digest of them: results are
exact but for collisions of such hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gavlake.llm.components import components
from gavlake.llm.scratch import (
    discard,
    lean_batches,
    lean_group,
    ship_by_value,
    shuffle_partitions,
    small_batches,
    staged,
)
from gavlake.llm.text import SpanHasher, lower_ascii, runs, shingles, spaces, text_slices

SIMILARITY_PCT = 80
SHINGLE_WORDS = 5
#: Sets of a group with which the others are compared first.
LEADERS = 8
#: Segments of a pair's sets whose overlaps are counted separately.
SEGMENTS = 4
#: N-grams of a fragment, which one task holds, on average at most; more make more fragments.
FRAGMENT_POSTINGS = 2_000_000
#: Largest table of names that is broadcast; above it the join shuffles.
MAX_BROADCAST_ROWS = 1_000_000


def need(n, pct):
    """Smallest overlap that a set of n can have with a partner."""
    return -(-pct * n // 100)


def _spare(n):
    """Common n-grams beyond the first that the extended prefix makes sure of."""
    return (n + 9) // 10


def _sets(column, size) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each text."""
    hasher, white = SpanHasher(), spaces()
    for first, raw, offsets in text_slices(column):
        low = lower_ascii(raw)
        starts, ends, words = runs(~white[low], offsets)
        h, at = shingles(hasher(low, starts, ends), words, size)
        for r in range(len(at) - 1):
            yield first + r, np.unique(h[at[r]:at[r + 1]])


def _name(tokens) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little",
                          signed=True)


def shingle_sets(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, n, k, text_key) per row: size and name of its set, and a key of its text."""

    def measure(batches):
        for batch in batches:
            n = np.zeros(batch.num_rows, np.int64)
            k = np.zeros(batch.num_rows, np.int64)
            for r, tokens in _sets(batch.column("text"), size):
                n[r], k[r] = len(tokens), _name(tokens)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n), pa.array(k), batch.column("text_key")],
                ["doc_id", "n", "k", "text_key"])

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    return rows.select("doc_id", "text", "text_key").mapInArrow(
        lean_batches(measure), "doc_id bigint, n bigint, k bigint, text_key bigint")


def _kept(n, pct):
    """Size of the extended prefix of a set of n."""
    return min(n, n - need(n, pct) + _spare(n))


def _cut(tokens, fragments):
    """Fragment of each hash; the order is cut evenly."""
    return (tokens >> np.uint64(32)).astype(np.int64) * fragments >> 32


def _fragments(spark, postings, whole):
    """Number of fragments for so many n-grams.

    Prefixes of large sets lie in the lower half of the order, but those of a few n-grams
    anywhere, so for prefixes both halves have as many fragments as whole sets have.
    """
    least = 4 * shuffle_partitions(spark)
    return (1 if whole else 2) * max(least, -(-postings // FRAGMENT_POSTINGS))


def _postings(docs, fragments, size, pct, whole):
    """(fragment, tokens, names): n-grams of extended prefixes (or whole sets), once a task.

    N-grams of prefixes go as their low 32 bits: a fragment's range fixes most of the rest,
    and where two of them match by chance a set only stays that the next count drops.
    """
    width = np.uint64 if whole else np.uint32

    def emit(batches):
        seen: set[int] = set()
        for batch in batches:
            toks, names = [], []
            for _, tokens in _sets(batch.column("text"), size):
                k = _name(tokens)
                if not len(tokens) or k in seen:
                    continue
                seen.add(k)
                n = len(tokens)
                keep = n if whole else _kept(n, pct)
                toks.append(tokens[:keep])
                names.append(np.full(keep, k, np.int64))
            if not toks:
                continue
            toks, names = np.concatenate(toks), np.concatenate(names)
            at = _cut(toks, fragments)
            order = np.argsort(at, kind="stable")
            at, toks, names = at[order], toks[order].astype(width), names[order]
            edge = np.flatnonzero(np.diff(at, prepend=-1))
            ends = np.append(edge[1:], len(at))
            yield pa.RecordBatch.from_arrays(
                [pa.array(at[edge].astype(np.int32)),
                 pa.array([toks[a:b].tobytes() for a, b in zip(edge, ends)], pa.binary()),
                 pa.array([names[a:b].tobytes() for a, b in zip(edge, ends)], pa.binary())],
                ["fragment", "tokens", "names"])

    return docs.select("text").mapInArrow(lean_batches(emit), "fragment int, tokens binary, names binary")


def _gather(table, dtype):
    parts = [np.frombuffer(x, dtype) for x in table.column("tokens").to_pylist()]
    names = [np.frombuffer(x, np.int64) for x in table.column("names").to_pylist()]
    toks, names = np.concatenate(parts), np.concatenate(names)
    order = np.lexsort((names, toks))
    toks, names = toks[order], names[order]
    new = np.ones(len(toks), bool)
    new[1:] = (toks[1:] != toks[:-1]) | (names[1:] != names[:-1])
    toks, names = toks[new], names[new]
    edge = np.flatnonzero(np.concatenate([[True], toks[1:] != toks[:-1]]))
    df = np.diff(np.append(edge, len(toks)))
    return toks, names, np.repeat(df, df)


def _partial_counts(postings: DataFrame) -> DataFrame:
    """(k, shared): per fragment, how many n-grams of a set another set has as well."""

    def count(table: pa.Table) -> pa.Table:
        _, names, df = _gather(table, np.uint32)
        k, shared = np.unique(names[df > 1], return_counts=True)
        return pa.table({"k": k, "shared": shared.astype(np.int64)})

    return postings.groupBy("fragment").applyInArrow(lean_group(count), "k bigint, shared bigint")


def _frequencies(postings: DataFrame) -> DataFrame:
    """(k, token, df): per fragment, the n-grams that several sets have, and how many have them."""

    def count(table: pa.Table) -> pa.Table:
        toks, names, df = _gather(table, np.uint64)
        shared = df > 1
        return pa.table({"k": names[shared], "token": toks[shared].view(np.int64),
                         "df": df[shared].astype(np.int32)})

    return postings.groupBy("fragment").applyInArrow(lean_group(count), "k bigint, token bigint, df int")


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= MAX_BROADCAST_ROWS else df


def linked_sets(docs: DataFrame, sets: DataFrame, pct: int, size: int) -> DataFrame | None:
    """(k, root) of the sets that link with another set; root names their component."""
    spark = docs.sparkSession
    of_prefix = f"least(n, n - ({pct} * n + 99) div 100 + (n + 9) div 10)"
    distinct = sets.where("n > 0").groupBy("k", "n").agg(F.count("*").alias("c"))
    postings = distinct.agg(F.sum(F.expr(of_prefix)).alias("p")).first()["p"] or 0
    fragments = _fragments(spark, postings, False)
    hits = (_partial_counts(_postings(docs, fragments, size, pct, False))
            .groupBy("k").agg(F.sum("shared").alias("shared")))
    # of all rows with one set, one goes on; a partner's prefix may be shorter, hence spare(need)
    least = F.expr(f"greatest(1, (({pct} * n + 99) div 100 + 9) div 10)")
    kept = staged(
        sets.where("n > 0").groupBy("k", "n")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")).alias("row"))
        .join(hits, "k").where(F.col("shared") >= least)
        .select("k", "n", "row.doc_id", "row.text_key"), "kept")
    rows, postings = kept.agg(F.count("*"), F.sum("n")).first()
    if not rows:
        discard(kept)
        return None
    chosen = kept.select(F.col("doc_id").alias("d"), F.col("text_key").alias("t"))
    left = docs.select("doc_id", "text").join(
        _bounded(chosen, rows),
        F.col("doc_id").eqNullSafe(F.col("d")) & (F.xxhash64("text") == F.col("t")), "left_semi")
    left = staged(left, "candidates")
    fragments = _fragments(spark, postings, True)

    # whole sets of what is left: n-grams that nothing else has settle nothing but the size
    shared = staged(
        _frequencies(_postings(left, fragments, size, pct, True))
        .groupBy("k").agg(F.collect_list(F.struct("df", "token")).alias("parts"))
        .join(kept.select("k", "n"), "k"), "shared")
    segments = staged(_ordered(shared, pct), "segments")
    discard(left, shared, kept)
    seg = segments.where("segment >= 0").select("k", "n", "segment", "tokens")
    heads = (segments.where("segment = -1")
             .select("k", "n", F.posexplode("tokens").alias("pos", "token"), "first")
             .select("k", "n", "first", "token", (F.col("n") - F.col("first") - F.col("pos")).alias("rest")))
    heads = staged(heads, "heads")

    # leaders: the sets of a group with the fewest n-grams of their own, which are nearest to most
    near = Window.partitionBy("token").orderBy("first", F.xxhash64("k"), "k")
    lead = (heads.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= LEADERS)
            .select("token", F.col("k").alias("a"), F.col("n").alias("na"), F.col("rest").alias("ra")))
    pairs = _possible(heads.join(lead, "token").where("a <> k"), pct)
    links = _links(pairs, seg, pct)
    roots = components(links)

    # the rest: pairs of one group that are in different components so far
    tagged = (heads.join(roots.select(F.col("v").alias("k"), "root"), "k", "left")
              .withColumn("root", F.coalesce("root", "k")))
    tagged = staged(tagged, "tagged")
    sizes = tagged.groupBy("token", "root").agg(F.count("*").alias("c"))
    main = (sizes.groupBy("token")
            .agg(F.max_by("root", F.struct("c", "root")).alias("main"), F.count("*").alias("roots"))
            .where("roots > 1"))
    mixed = tagged.join(main, "token")
    minor = (mixed.where("root <> main")
             .select("token", F.col("k").alias("a"), F.col("n").alias("na"),
                     F.col("rest").alias("ra"), F.col("root").alias("root_a")))
    rest = _possible(mixed.join(minor, "token")
                     .where("root <> root_a and (root = main or root_a < root)"), pct)
    more = _links(rest, seg, pct)
    if not more.isEmpty():
        discard(roots)
        roots = components(links.unionByName(more))
    discard(segments, heads, tagged, links, more)
    return roots.select(F.col("v").alias("k"), "root")


def _possible(joined: DataFrame, pct: int) -> DataFrame:
    """Distinct pairs that can reach the similarity, by size and by position.

    ``rest`` is a set's number of n-grams from the common one on, so at a pair's first common
    n-gram no more than the smaller ``rest`` can be common.
    """
    most = F.least("rest", "ra")
    ok = (100 + pct) * most >= pct * (F.col("n") + F.col("na"))
    return (joined.where(ok)
            .select(F.least("a", "k").alias("a"), F.greatest("a", "k").alias("b"),
                    F.when(F.col("a") < F.col("k"), F.col("na")).otherwise(F.col("n")).alias("na"),
                    F.when(F.col("a") < F.col("k"), F.col("n")).otherwise(F.col("na")).alias("nb"))
            .distinct())


def _links(pairs: DataFrame, seg: DataFrame, pct: int) -> DataFrame:
    """The pairs that link: overlaps are counted per segment and summed per pair."""
    of_a = seg.select(F.col("k").alias("a"), "segment", F.col("tokens").alias("ta"))
    of_b = seg.select(F.col("k").alias("b"), "segment", F.col("tokens").alias("tb"))
    parts = (pairs.join(of_b, "b").join(of_a, ["a", "segment"])
             .select("a", "b", "na", "nb", F.size(F.array_intersect("ta", "tb")).alias("part")))
    sums = parts.groupBy("a", "b", "na", "nb").agg(F.sum("part").alias("common"))
    return staged(sums.where(f"{100 + pct} * common >= {pct} * (na + nb)").select("a", "b"), "links")


def _ordered(shared: DataFrame, pct: int) -> DataFrame:
    """(k, n, segment, first, tokens) of the sets that can still link.

    Segment -1 is the head: the n-grams of the prefix, rare ones first, that other sets have;
    ``first`` is the number of n-grams before it, which no other set has.
    """

    def order(batches):
        for batch in batches:
            ks, ns, segs, firsts, toks = [], [], [], [], []
            for k, n, parts in zip(*(batch.column(c) for c in ("k", "n", "parts"))):
                k, n, parts = k.as_py(), n.as_py(), parts.values
                if len(parts) < need(n, pct):
                    continue
                tok = parts.field("token").to_numpy().view(np.uint64)
                df = parts.field("df").to_numpy()
                alone = n - len(tok)
                head = tok[np.lexsort((tok, df))][:n - need(n, pct) + 1 - alone]
                tok = np.sort(tok)
                at = (tok >> np.uint64(62)).astype(np.int64) * SEGMENTS // 4
                for s, part in [(-1, head), *((s, tok[at == s]) for s in range(SEGMENTS))]:
                    if len(part):
                        ks.append(k)
                        ns.append(n)
                        segs.append(s)
                        firsts.append(alone)
                        toks.append(part.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ks, pa.int64()), pa.array(ns, pa.int64()), pa.array(segs, pa.int32()),
                 pa.array(firsts, pa.int64()), pa.array(toks, pa.list_(pa.int64()))],
                ["k", "n", "segment", "first", "tokens"])

    return shared.select("k", "n", "parts").mapInArrow(
        lean_batches(order), "k bigint, n bigint, segment int, first bigint, tokens array<bigint>")


def jaccard_components(docs: DataFrame, pct: int = SIMILARITY_PCT,
                       size: int = SHINGLE_WORDS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): (doc_id, n_shingles, component_id, text_key, root).

    ``component_id`` is the smallest doc_id that links reach, the row's own included; null
    ids count only where nothing else is there. Rows with one set are one component, which
    ``root`` names. A row without words (null or empty text) has an empty set and links with
    nothing: its own doc_id, and no root. An empty table gives an empty one. Other columns
    of ``docs`` are not read.
    """
    small_batches(docs.sparkSession)
    sets = staged(shingle_sets(docs, size), "sets")
    roots = linked_sets(docs, sets, pct, size)
    classes = sets.where("n > 0").groupBy("k").agg(F.min("doc_id").alias("least"))
    if roots is None:
        classes = classes.select("k", F.col("k").alias("root"), F.col("least").alias("component_id"))
    else:
        rooted = classes.join(roots, "k", "left").withColumn("root", F.coalesce("root", "k"))
        # written, so that the join's sides are both plain exchanges, which AQE can split
        ids = staged(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "ids")
        classes = rooted.join(ids, "root").select("k", "root", "component_id")
    own = F.col("n") == 0
    return (sets.join(classes, (sets["k"] == classes["k"]) & (sets["n"] > 0), "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(own, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                    "text_key", "root"))


def one_per_component(docs: DataFrame, pct: int = SIMILARITY_PCT) -> DataFrame:
    """``docs`` with one row of each component: the smallest doc_id's, null last.

    Of several texts with that doc_id the one with the smallest key stays, and of rows equal
    in doc_id and text one. Rows without words all stay.
    """
    parts = staged(jaccard_components(docs, pct).where("root is not null")
                   .select("root", "doc_id", "text_key"), "parts")
    rows = parts.groupBy("root", "doc_id", "text_key").agg(F.count("*").alias("c"))
    first = staged(parts.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("u"), "doc_id", "text_key")).alias("row")), "first")
    rows = staged(rows.join(first, "root").select(
        F.col("doc_id").alias("_d"), F.col("text_key").alias("_t"), "c",
        (F.col("row.doc_id").eqNullSafe(F.col("doc_id"))
         & (F.col("row.text_key") == F.col("text_key"))).alias("stays")), "rows")
    discard(parts, first)
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.xxhash64("text") == F.col("_t"))
    losers = rows.where("not stays").select("_d", "_t")
    kept = docs.join(_bounded(losers, losers.count()), same, "left_anti")
    repeated = rows.where("stays and c > 1").select("_d", "_t")
    n = repeated.count()
    if n:
        again = _bounded(repeated, n)
        kept = (kept.join(again, same, "left_anti")
                .unionByName(kept.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"])))
    return kept


ship_by_value(__name__)
