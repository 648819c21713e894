"""Line dedup by a log-template tree, in DataFrame functions only.

A tree of fixed depth parses the lines of all documents. A token with a digit is a variable field
from the start. The first level is a line's number of tokens, the next ``LEAD`` levels are its leading
tokens, and a leaf holds all lines that agree in these. A leaf has a list of groups: its lines are taken by
falling number of documents, and a line joins the first group whose seed has at least ``ALIKE`` of its
tokens in place, or else is the seed of a new group. Positions in which any line of a group differs from
the seed become variable, which makes the group's template. A template that recurs in at least ``MIN_DOCS``
documents is boilerplate, and its lines are dropped.

Lines of n tokens that are alike differ in at most e = (1 - ``ALIKE``) n places, so of e + 1 blocks of their
places after the leading tokens, they share one. Only lines with a common block are compared; a line that shares
none is a group of its own. Groups are made in rounds of ``SEEDS`` lines per leaf, until no line is left.

Tokens are parted by single spaces. Lines of fewer than ``MIN_TOKENS`` tokens, empty ones
too, carry no template: short phrases recur by chance.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gavlake.llm.scratch import discard, staged

LEAD = 3
ALIKE = 0.7
MIN_DOCS = 5
MIN_TOKENS = 4
#: Lines of a leaf that may become seeds in one round; the next round takes the next ones.
SEEDS = 256
#: Largest table of leaves or lines that is broadcast; above it the join shuffles.
MAX_BROADCAST_ROWS = 1_000_000
#: A token with a digit; possessive, and begun only where a token begins, so linear.
FIELD = r"(?<!\S)[^\s0-9]*+[0-9]\S*+"


def _lines(docs: DataFrame) -> DataFrame:
    """Adds ``_lines``, the lines of the text with variable fields blanked, in order."""
    blanked = F.when(F.col("text").rlike("[0-9]"), F.regexp_replace("text", FIELD, "<*>")).otherwise(F.col("text"))
    return docs.withColumn("_lines", F.split(F.coalesce(blanked, F.lit("")), "\n"))


#: SQL over a line ``l``: its number of tokens and its leaf.
_TOKENS = "length(l) - length(replace(l, ' ', '')) + 1"
_LEAF = f"xxhash64({_TOKENS}, substring_index(l, ' ', {LEAD}))"


def _row_key():
    return F.xxhash64("doc_id", "text")


def _bounded(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= MAX_BROADCAST_ROWS else df


#: SQL over ``tokens``: hashes of the blocks of places after the leading tokens, of which alike lines share one.
_PLACES = f"(size(tokens) - {LEAD})"
_BLOCKS = f"(cast(floor((1 - {ALIKE}D) * size(tokens)) as int) + 1)"
_KEYS = (f"transform(sequence(0, {_BLOCKS} - 1), j -> xxhash64(j, slice(tokens, "
         f"{LEAD} + 1 + j * {_PLACES} div {_BLOCKS}, "
         f"cast((j + 1) * {_PLACES} div {_BLOCKS} - j * {_PLACES} div {_BLOCKS} as int))))")
#: SQL over two arrays of tokens.
_ALIKE = ("size(filter(zip_with({a}, {b}, (p, q) -> p <> q), d -> d)) <= " f"(1 - {ALIKE}D) * size(" "{a})")


def _keys(lines: DataFrame, *columns: str) -> DataFrame:
    """``columns`` and ``key`` per block of each line."""
    keyed = lines.withColumn("tokens", F.split("text", " "))
    return keyed.select(*columns, F.explode(F.expr(_KEYS)).alias("key"))


def _groups(lines: DataFrame) -> DataFrame:
    """Staged (line, seed_line, seed_text) of the lines that share a block with another line of their leaf."""
    several = lines.groupBy("leaf").agg(F.count("*").alias("k")).where("k > 1").select("leaf")
    keys = staged(_keys(lines.join(several, "leaf", "left_semi"), "leaf", "line"), "blocks")
    common = keys.groupBy("leaf", "key").agg(F.count("*").alias("k")).where("k > 1").select("leaf", "key")
    near = keys.join(common, ["leaf", "key"], "left_semi").select("line").distinct()
    rest = staged(lines.join(near, "line", "left_semi").select("leaf", "line", "text", "c"), "ungrouped")
    discard(keys)
    order = Window.partitionBy("leaf").orderBy(F.desc("c"), F.desc("line"))
    first = F.expr("aggregate(top, filter(top, x -> false), (seeds, x) -> if(exists(seeds, s -> "
                   f"{_ALIKE.format(a='s.tokens', b='x.tokens')}), seeds, concat(seeds, array(x))))")
    rounds = []
    while not rest.isEmpty():
        # the lines of most documents; those that are alike to one before them are no seeds
        top = (rest.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= SEEDS)
               .groupBy("leaf").agg(F.sort_array(F.collect_list(F.struct(
                   "rank", "line", F.split("text", " ").alias("tokens")))).alias("top")))
        seeds = staged(top.select("leaf", F.explode(first).alias("s"))
                       .select("leaf", "s.rank", F.col("s.line").alias("seed_line"),
                               F.array_join("s.tokens", " ").alias("text")), "seeds")
        # every line left goes to the first seed that it is alike to
        met = (_keys(rest, "leaf", "line").join(_keys(seeds, "leaf", "seed_line"), ["leaf", "key"])
               .select("line", "seed_line").distinct())
        texts = seeds.select("seed_line", "rank", F.col("text").alias("seed_text"))
        met = (met.join(texts, "seed_line").join(rest.select("line", "text"), "line")
               .where(F.expr(_ALIKE.format(a="split(seed_text, ' ')", b="split(text, ' ')"))))
        found = staged(met.groupBy("line").agg(F.min_by(F.struct("seed_line", "seed_text"), "rank").alias("s"))
                       .select("line", "s.*"), "grouped")
        rounds.append(found)
        left = staged(rest.join(found, "line", "left_anti"), "ungrouped")
        discard(rest, seeds)
        rest = left
    discard(rest)
    if not rounds:
        return lines.select("line", F.col("line").alias("seed_line"), F.col("text").alias("seed_text")).limit(0)
    if len(rounds) == 1:
        return rounds[0]
    out = staged(reduce(DataFrame.unionByName, rounds), "grouped")
    discard(*rounds)
    return out


def templates(docs: DataFrame, min_docs: int = MIN_DOCS):
    """(line, template, docs) of every line in a leaf that recurs, and staged (row, line) pairs.

    ``line`` is the hash of the blanked line, ``docs`` the number of documents with a line of the template.
    """
    split = _lines(docs.select("doc_id", "text"))
    kept = f"filter(_lines, l -> {_TOKENS} >= {MIN_TOKENS})"
    leaves = (split.select(F.explode(F.expr(f"transform({kept}, l -> {_LEAF})")).alias("leaf"))
              .groupBy("leaf").count().where(F.col("count") >= min_docs).select("leaf"))
    leaves = staged(leaves, "leaves")
    seen = (split.select(_row_key().alias("row"), F.explode(F.expr(f"array_distinct({kept})")).alias("l"))
            .withColumn("leaf", F.expr(_LEAF)).join(_bounded(leaves), "leaf", "left_semi")
            .select("row", "leaf", F.xxhash64("l").alias("line"), F.col("l").alias("text")))
    seen = staged(seen, "lines")
    lines = staged(seen.groupBy("leaf", "line").agg(F.first("text").alias("text"), F.count("*").alias("c")),
                   "distinct_lines")
    grouped = _groups(lines)
    own = lines.join(grouped, "line").withColumns({
        "tokens": F.split("text", " "), "seed": F.split("seed_text", " ")})
    own = own.withColumn("apart", F.expr(
        "filter(sequence(0, size(seed) - 1), i -> tokens[i] <> seed[i])"))
    own = staged(own.select("line", "seed_line", "seed", "apart"), "compared")
    # a group's variable positions are at most as many as its tokens
    variable = (own.select("seed_line", F.explode("apart").alias("i"))
                .groupBy("seed_line").agg(F.collect_set("i").alias("variable")))
    of_seed = F.expr("array_join(transform(seed, (t, i) -> "
                     "if(array_contains(coalesce(variable, cast(array() as array<int>)), i), '<*>', t)), ' ')")
    single = lines.join(grouped, "line", "left_anti").select("line", F.col("text").alias("template"))
    named = (own.join(variable, "seed_line", "left").select("line", of_seed.alias("template"))
             .unionByName(single))
    named = staged(named, "templates")
    pairs = seen.select("row", "line")
    docs_of = (pairs.join(named, "line").select(F.xxhash64("template").alias("t"), "row").distinct()
               .groupBy("t").agg(F.count("*").alias("docs")))
    counted = staged(named.withColumn("t", F.xxhash64("template")).join(docs_of, "t")
                     .select("line", "template", "docs"), "counted")
    discard(leaves, lines, grouped, own, named)
    return counted, pairs, seen


def drop_templates(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` without the lines of recurring templates; adds n_lines and n_dropped.

    A null text stays null and has no lines; an empty text has one. Rows equal in doc_id and
    text are one document where documents are counted, and all lose the same lines. Other
    columns stay, but those called n_lines or n_dropped.
    """
    docs = docs.drop("n_lines", "n_dropped")
    counted, pairs, seen = templates(docs, min_docs)
    gone = counted.where(F.col("docs") >= min_docs).select("line")
    # per document at most as many as it has lines
    drops = staged(pairs.join(gone, "line", "left_semi").groupBy("row")
                   .agg(F.collect_set("line").alias("_drops")), "drops")
    discard(seen, counted)
    rows = _lines(docs).withColumn("_row", _row_key())
    rows = rows.join(drops.withColumnRenamed("row", "_row"), "_row", "left")
    keep = F.expr("filter(split(text, '\\n'), (x, i) -> not array_contains(_drops, xxhash64(_lines[i])))")
    rows = rows.withColumn("_kept", F.when(F.col("_drops").isNull(), F.split("text", "\n")).otherwise(keep))
    n = F.when(F.col("text").isNull(), 0).otherwise(F.size("_lines"))
    text = F.when(F.col("_drops").isNull(), F.col("text")).otherwise(F.array_join("_kept", "\n"))
    return rows.select(*(text.alias("text") if c == "text" else F.col(c) for c in docs.columns),
                       n.cast("bigint").alias("n_lines"),
                       (n - F.when(F.col("text").isNull(), 0).otherwise(F.size("_kept")))
                       .cast("bigint").alias("n_dropped"))


def line_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_chars, kept_sha256) per row of ``docs``."""
    kept = drop_templates(docs.select("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    return kept.select("doc_id", "n_lines", "n_dropped", F.length(text).cast("bigint").alias("kept_chars"),
                       F.sha2(text, 256).alias("kept_sha256"))
