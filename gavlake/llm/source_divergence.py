"""Divergence of the sources of a language, on exact sparse count vectors.

Each document becomes a sparse vector of term counts, as a count vectorizer fitted per language
with a minimum document frequency and no vocabulary limit (the largest integer vocabulary size)
gives it. The vectors of a (lang, source) group are summed, first within a task and then over all
tasks. Vocabulary, sums and documents stay tables: nothing of them is gathered in the driver.

A group's probability of a term is smoothed and scaled to integers, so all arithmetic is exact. Two
groups are compared over the whole vocabulary, but only terms that one of them holds are visited:
all others have the same two probabilities, and their share is one product.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gavlake.llm.scratch import BATCH_BYTES, discard, ship_by_value, small_batches, staged
from gavlake.llm.text import lower_ascii, runs, text_slices

#: Documents of a language that a kept term is in, at least.
MIN_DF = 3
#: Terms that a group reports.
TOP_TERMS = 200
#: Parts that a group's terms are ranked in before they are ranked together.
RANK_PARTS = 16
#: A probability of 1: fixed value.
SCALE = 1_000_000_000


def _letters():
    """Table of the bytes of terms: ASCII letters and all of non-ASCII characters."""
    table = np.zeros(256, bool)
    table[65:91] = table[97:123] = True
    table[128:] = True
    return table


def document_vectors(raw, offsets):
    """Sparse count vectors of texts: (terms, row, term index, count), by row and term index."""
    low = lower_ascii(raw)
    inside = _letters()[low]
    starts, ends, first = runs(inside, offsets)
    # the runs' bytes in order are the terms one after the other
    at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=at[1:])
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(at), pa.py_buffer(low[inside].tobytes()))
    coded = words.dictionary_encode()
    size = max(len(coded.dictionary), 1)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    cell, count = np.unique(row * size + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
    return coded.dictionary, cell // size, cell % size, count


def _sum_vectors(batches):
    """Sums of the document vectors of each (lang, source), and in how many documents a term is."""
    for batch in batches:
        names = pa.StructArray.from_arrays(
            [pc.fill_null(batch.column(k).cast(pa.string()), "") for k in (0, 1)], ["lang", "source"])
        pairs = [names.field(k).dictionary_encode() for k in (0, 1)]
        wide = max(len(pairs[1].dictionary), 1)
        group = (pairs[0].indices.to_numpy(zero_copy_only=False).astype(np.int64) * wide
                 + pairs[1].indices.to_numpy(zero_copy_only=False))
        for begin, raw, offsets in text_slices(batch.column(2), BATCH_BYTES):
            terms, row, term, count = document_vectors(raw, offsets)
            if not len(row):
                continue
            cell = group[begin + row] * len(terms) + term
            order = np.argsort(cell, kind="stable")
            cell = cell[order]
            edge = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
            own, word = cell[edge] // len(terms), cell[edge] % len(terms)
            yield pa.RecordBatch.from_arrays(
                [pairs[0].dictionary.take(pa.array(own // wide)), pairs[1].dictionary.take(pa.array(own % wide)),
                 terms.take(pa.array(word)).cast(pa.string()),
                 pa.array(np.add.reduceat(count[order], edge)),
                 pa.array(np.diff(np.r_[edge, len(cell)]))],
                ["lang", "source", "term", "n", "df"])


def _probability(count: str, total: str) -> str:
    """1 + floor(SCALE * (count + 1) / (total + terms)), in decimals: counts times SCALE outgrow a long."""
    return (f"1 + ({SCALE}BD * (cast({count} as decimal(20,0)) + 1)) "
            f"div (cast({total} as decimal(20,0)) + terms)")


def _f(p: str, q: str) -> str:
    """floor((p - q)^2 / q); the square stays below 2^63, as no probability is above SCALE + 1."""
    return f"((({p}) - ({q})) * (({p}) - ({q}))) div ({q})"


def source_divergence(docs: DataFrame, min_df: int = MIN_DF, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): how the sources of each language differ.

    Part ``pair``: the divergence of each other source of the language, all ranks; part ``term``:
    the group's own terms that it holds more often than its language, ``top_terms`` at most. A null
    text, lang or source counts as ''. Groups without terms count; a language without kept terms
    has pairs of value 0. Every row is a document, repeated ones too; doc_id and other columns are not
    read. An empty table gives no rows; ties are ranked by item. A very hot term or
    group is summed within tasks before it is moved, and ranked in parts.
    """
    small_batches(docs.sparkSession)
    lang, source = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))
    parts = docs.select(lang, source, F.col("text").cast("string").alias("text")).mapInArrow(
        _sum_vectors, "lang string, source string, term string, n bigint, df bigint")
    counts = staged(parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df")),
                    "divergence_counts")
    kept = (counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("df").alias("df"))
            .where(F.col("df") >= min_df).drop("df"))
    vectors = staged(counts.drop("df").join(kept, ["lang", "term"]), "divergence_vectors")

    # one row a group: all words, those of its language, the language's terms
    words = vectors.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("own"))
    langs = kept.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count("*").alias("terms"))
    groups = staged(
        docs.select(lang, source).distinct().join(words, ["lang", "source"], "left").join(langs, "lang", "left")
        .na.fill(0, ["total", "own", "lang_total", "terms"])
        .withColumn("p0", F.expr(f"case when terms > 0 then {_probability('0', 'total')} end")),
        "divergence_groups")
    chances = staged(
        vectors.join(groups.select("lang", "source", "total", "lang_total", "terms", "p0"), ["lang", "source"])
        .selectExpr("lang", "source", "term", "p0", f"{_probability('n', 'total')} as p",
                    f"{_probability('lang_n', 'lang_total')} as q"), "divergence_chances")
    out = _pairs(groups, chances).unionByName(_terms(chances, top_terms))
    result = staged(out, "divergence")
    discard(counts, vectors, groups, chances)
    return result


def _pairs(groups: DataFrame, chances: DataFrame) -> DataFrame:
    """Part ``pair``.

    The sum over the vocabulary is that of a term neither group holds, times all terms, then for
    each term held what differs from it: terms of one side need the other side's zero probability
    only, so they are counted by their probability first; terms of both are joined.
    """
    a = groups.select("lang", F.col("source").alias("a"), F.col("p0").alias("a0"), "terms")
    b = groups.select("lang", F.col("source").alias("b"), F.col("p0").alias("b0"))
    none = a.join(b, "lang").where("a <> b").selectExpr(
        "lang", "a", "b", f"case when terms > 0 then terms * ({_f('a0', 'b0')}) else 0 end as v")
    held = chances.groupBy("lang", F.col("source").alias("a"), F.col("p0").alias("a0"), "p").agg(
        F.count("*").alias("k"))
    one = held.join(b, "lang").where("a <> b").selectExpr("lang", f"""stack(2,
        a, b, k * (({_f('p', 'b0')}) - ({_f('a0', 'b0')})),
        b, a, k * (({_f('b0', 'p')}) - ({_f('b0', 'a0')}))) as (a, b, v)""")
    x = chances.select("lang", "term", F.col("source").alias("a"), F.col("p").alias("pa"), F.col("p0").alias("a0"))
    y = chances.select("lang", "term", F.col("source").alias("b"), F.col("p").alias("pb"), F.col("p0").alias("b0"))
    both = x.join(y, ["lang", "term"]).where("a < b").selectExpr("lang", f"""stack(2,
        a, b, ({_f('pa', 'pb')}) - ({_f('pa', 'b0')}) - ({_f('a0', 'pb')}) + ({_f('a0', 'b0')}),
        b, a, ({_f('pb', 'pa')}) - ({_f('pb', 'a0')}) - ({_f('b0', 'pa')}) + ({_f('b0', 'a0')})) as (a, b, v)""")
    sums = none.unionByName(one).unionByName(both).groupBy("lang", "a", "b").agg(F.sum("v").alias("value"))
    by = Window.partitionBy("lang", "a").orderBy(F.desc("value"), "b")
    return sums.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"),
                       "value", F.row_number().over(by).alias("rank"))


def _terms(chances: DataFrame, top_terms: int) -> DataFrame:
    """Part ``term``: ranked within parts of a group, then what is left of them together."""
    rows = chances.where("p > q").selectExpr("lang", "source", "term as item", f"{_f('p', 'q')} as value")
    order = [F.desc("value"), "item"]
    salt = F.pmod(F.xxhash64("item"), F.lit(RANK_PARTS))
    some = (rows.withColumn("salt", salt)
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source", "salt").orderBy(*order)))
            .where(F.col("rank") <= top_terms).drop("rank", "salt"))
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order)))
    return ranked.where(F.col("rank") <= top_terms).select(
        "lang", "source", F.lit("term").alias("part"), "item", "value", "rank")


ship_by_value(__name__)
