"""Mixing sources to target weights by min-cost flow.

Documents are aggregated by membership pattern, the set of sources that they belong to. A flow
network routes words from patterns to source quotas: a pattern offers its words once at cost
1, a second time at cost 3 (the increments of the square, a convex cost of repetition), so words
are repeated only where fresh ones are short. The flow says how many words of each
pattern to take; whole documents are then selected in the order of a seeded hash of
doc_id and text until their words come nearest to that number.
"""

from __future__ import annotations

from collections.abc import Iterable
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gavlake.llm.scratch import discard, ship_by_value, small_batches, staged
from gavlake.llm.text import runs, spaces, text_slices

WEIGHTS = (3, 1, 2)
SHARE_PCT = 150
MOST_COPIES = 2
SEED = 20240601
#: Patterns of sources that one mix may have: they are a setting of the mix, not data.
MAX_PATTERNS = 50_000
_BITS, _LEVELS = 12, 3


def targets(sizes: dict, share_pct: int = SHARE_PCT, weights: Iterable[int] = WEIGHTS) -> dict:
    """Words wanted of each source: a share by weight, never above MOST_COPIES times its size.

    Sources take the weights in turn, by code point, null last. What a source cannot take is
    shared among the others by weight, until none is above its bound.
    """
    weights = list(weights)
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left = Fraction(share_pct, 100) * sum(sizes.values())
    out: dict = {}
    free = list(order)
    while free:
        total = sum(weight[s] for s in free)
        full = [s for s in free if left * weight[s] > total * MOST_COPIES * sizes[s]]
        if not full:
            out |= {s: left * weight[s] / total for s in free}
            break
        for s in full:
            out[s] = Fraction(MOST_COPIES * sizes[s])
            left -= out[s]
        free = [s for s in free if s not in out]
    return out


def route(sizes: dict, quotas: dict, members: dict) -> dict:
    """Words to take of each pattern: a min-cost maximum flow from patterns to quotas.

    ``sizes``: words by pattern; ``quotas``: whole words by source; ``members``: the sources of each pattern.
    Shortest paths are augmented until no quota can be filled further.
    """
    names = ["in", *(("p", p) for p in sizes), *(("s", s) for s in quotas), "out"]
    node = {x: i for i, x in enumerate(names)}
    arcs: list[list[int]] = []  # to, room, cost; arc i ^ 1 is the reverse of arc i
    leaving: list[list[int]] = [[] for _ in names]

    def arc(a, b, room, cost):
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            leaving[x].append(len(arcs))
            arcs.append([y, r, c])

    for p, size in sizes.items():
        for copy in range(1, MOST_COPIES + 1):
            arc(0, node["p", p], size, 2 * copy - 1)
        for s in members[p]:
            arc(node["p", p], node["s", s], MOST_COPIES * size, 0)
    for s, quota in quotas.items():
        arc(node["s", s], len(names) - 1, quota, 0)
    while True:
        cost, via = [0, *[None] * (len(names) - 1)], [-1] * len(names)
        queue = [0]
        while queue:
            nearer = []
            for x in queue:
                for i in leaving[x]:
                    to, room, c = arcs[i]
                    if room > 0 and (cost[to] is None or cost[x] + c < cost[to]):
                        cost[to], via[to] = cost[x] + c, i
                        nearer.append(to)
            queue = list(dict.fromkeys(nearer))
        at, path = len(names) - 1, []
        if cost[at] is None:
            break
        while at:
            path.append(via[at])
            at = arcs[via[at] ^ 1][0]
        room = min(arcs[i][1] for i in path)
        for i in path:
            arcs[i][1] -= room
            arcs[i ^ 1][1] += room
    taken = dict.fromkeys(sizes, 0)
    for i in leaving[0]:
        taken[names[arcs[i][0]][1]] += arcs[i ^ 1][1]
    return taken


def with_words(docs: DataFrame, *columns) -> DataFrame:
    """``columns`` of ``docs`` and ``size``, the number of runs of other than white space."""
    rows = docs.select(*columns, F.col("text").alias("_words_of"))
    schema = docs.select(*columns, F.lit(0).cast("bigint").alias("size")).schema

    def count(batches):
        white = spaces()
        for batch in batches:
            n = [np.diff(runs(~white[raw], offsets)[2])
                 for _, raw, offsets in text_slices(batch.column("_words_of"))]
            at = batch.schema.get_field_index("_words_of")
            size = np.concatenate(n) if n else np.zeros(0, np.int64)
            yield batch.remove_column(at).append_column("size", pa.array(size, pa.int64()))

    return rows.mapInArrow(count, schema)


def _place() -> Column:
    """A document's place in the seeded order, in 36 bits."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "doc_id", "text"), 64 - _BITS * _LEVELS)


def _pattern(members: Column) -> Column:
    return F.to_json(F.array_sort(F.array_distinct(members)))


def plan_mix(docs: DataFrame, members: Column | None = None):
    """(plan, targets, sizes of sources, staged (doc_id, sources, pattern, place, size)).

    The plan has a row (pattern, copies, cut) per pattern: its documents are taken
    ``copies`` times, and once more where their place is below ``cut``.
    """
    spark = docs.sparkSession
    small_batches(spark)
    members = F.array("source") if members is None else members
    rows = staged(with_words(docs, "doc_id", F.array_sort(F.array_distinct(members)).alias("sources"),
                             _pattern(members).alias("pattern"), _place().alias("place")), "mix")
    found = (rows.groupBy("pattern", "sources").agg(F.sum("size").alias("size"))
             .limit(MAX_PATTERNS + 1).collect())
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} patterns of sources")
    found.sort(key=lambda r: r.pattern)
    sizes = {r.pattern: r["size"] for r in found}
    of = {r.pattern: list(r.sources) for r in found}
    by_source: dict = {}
    for p, n in sizes.items():
        for s in of[p]:
            by_source[s] = by_source.get(s, 0) + n
    wanted = targets(by_source)
    taken = route(sizes, {s: round(t) for s, t in wanted.items()}, of)
    state = []
    for p, n in sizes.items():
        copies, rest = divmod(taken[p], n) if n else (0, 0)
        state.append((p, copies, rest, 0))
    schema = "pattern string, copies int, rest bigint, cut bigint"
    for level in range(1, _LEVELS + 1):
        shift = _BITS * (_LEVELS - level)
        known = F.broadcast(spark.createDataFrame(state, schema))
        sums = (rows.join(known, "pattern")
                .where(F.shiftright("place", shift + _BITS) == F.col("cut"))
                .groupBy("pattern", "copies", "rest", "cut", F.shiftright("place", shift).alias("at"))
                .agg(F.sum("size").alias("n")))
        upto = Window.partitionBy("pattern").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
        edge = (sums.withColumn("sum", F.sum("n").over(upto))
                .where("sum > rest").groupBy("pattern")
                .agg(F.min_by(F.struct("at", "n", (F.col("rest") - F.col("sum") + F.col("n")).alias("rest")),
                              "at").alias("e")).collect())
        edges = {r.pattern: r.e for r in edge}
        state = [(p, c, edges[p]["rest"], edges[p]["at"]) if p in edges else (p, c, 0, cut << _BITS)
                 for p, c, _, cut in state]
    plan = [(p, c, cut + (1 if p in edges and 2 * rest >= edges[p]["n"] and rest else 0))
            for p, c, rest, cut in state]
    return plan, wanted, by_source, rows


def _copies() -> Column:
    return F.col("copies") + F.when(F.col("place") < F.col("cut"), 1).otherwise(0)


def mix_report(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) per row of ``docs``; each has one source.

    ``taken`` is the words that the mix takes of the document: 0, 1 or 2 times its size.
    A null text has size 0, a null source is a source of its own and comes last. Rows equal
    in doc_id and text have one place in the order and are taken alike. Of extra columns
    none is read; an empty table gives no rows.
    """
    plan, wanted, sizes, rows = plan_mix(docs)
    spark = docs.sparkSession
    table = F.broadcast(spark.createDataFrame(plan, "pattern string, copies int, cut bigint"))
    quotas = F.broadcast(spark.createDataFrame(
        [(s, sizes[s], float(wanted[s])) for s in sizes],
        "_source string, source_size bigint, target double"))
    return (rows.join(table, "pattern")
            .join(quotas, F.col("sources")[0].eqNullSafe(F.col("_source")))
            .select("doc_id", "size", "source_size", "target",
                    (F.col("size") * _copies()).alias("taken")))


def mixed(docs: DataFrame, members: Column | None = None) -> DataFrame:
    """``docs`` as the mix takes them: a row per copy, none for documents left out."""
    plan, _, _, rows = plan_mix(docs, members)
    discard(rows)
    table = F.broadcast(docs.sparkSession.createDataFrame(
        plan, "_pattern string, copies int, cut bigint"))
    members = F.array("source") if members is None else members
    whole = docs.select(F.struct(*docs.columns).alias("_row"), _pattern(members).alias("_pattern"),
                        _place().alias("place"))
    return (whole.join(table, "_pattern")
            .select(F.col("_row"), F.explode(F.array_repeat(F.lit(1), _copies())).alias("_copy"))
            .select("_row.*"))


ship_by_value(__name__)
