"""Training-corpus pipeline: five stages over ``documents``, each written and read again.

Part of the subpackage ``gavlake.llm``. Every stage takes (spark, docs, sf_dir) and works on
all that its predecessor kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gavlake.llm.decontaminate import decontaminated
from gavlake.llm.jaccard_join import one_per_component
from gavlake.llm.language import fit_languages, identify
from gavlake.llm.mixing import mixed
from gavlake.llm.scratch import discard, staged
from gavlake.llm.sharding import assign_shards


#: Names that no column of ``documents`` has.
PREDICTED, POSTERIOR = "_pipeline_lang_pred", "_pipeline_posterior"
#: Languages that are kept (None: every one that is learned), and the least posterior of the predicted one: a
#: text that no learned language explains better than the others together is in none of them.
LANGUAGES: tuple[str, ...] | None = None
LEAST_POSTERIOR = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose predicted language is one of ``LANGUAGES``, with a posterior of ``LEAST_POSTERIOR``.

    Those without a letter go (null and empty texts too). The ``lang`` column is learned from,
    never trusted for a row's own decision. Repeated rows fare alike; if no row has a language, none is kept.
    """
    found = identify(docs, fit_languages(docs), names=(PREDICTED, POSTERIOR))
    kept = found.where((F.col(PREDICTED) != "und") & (F.col(POSTERIOR) >= LEAST_POSTERIOR))
    if LANGUAGES is not None:
        kept = kept.where(F.col(PREDICTED).isin(list(LANGUAGES)))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of 5-word-shingle similarity 0.8 join.

    Of rows that are equal in everything one stays; texts without words link with nothing.
    """
    return one_per_component(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ``benchmark``; with an empty benchmark all stay, as do null texts."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix takes them: none, one or two rows each.

    A null source is a source of its own; texts without words have size 0. Rows that are equal in doc_id
    and text are taken alike.
    """
    return mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row of the mix.

    Copies of a document share a shard and have a slot each; a null doc_id is a key like any other.
    """
    return assign_shards(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mix_sources", mix_sources),
    ("shard", shard),
]

#: The stages learn models and select by hashes, which SQL cannot express; the tests hold
#: ``run`` against a plain Python version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn, from ``documents``; each result is written as Parquet and reread, and removed
    once the next one is written.

    Columns that ``documents`` has besides its own go through all stages but the last; empty
    tables give an empty result.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
        if before is not None:
            discard(before)
        before = docs
    return docs
