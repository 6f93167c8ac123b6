"""From raw documents to training shards: rules, near-duplicates, benchmark leaks, source mix, shards.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame that is written
and read again before the next stage. All but the last give the columns of the
documents they got.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farekit.llm import decontaminate, mixing, quality, sharding, simhash
from farekit.session import stage


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the base rules and the certified cutoffs keep.

    Null and empty texts have no word and go. Repeated rows fare alike; texts of
    any length are counted whole. Without labels the base rules alone decide.
    An empty table stays empty, and columns of any name pass through.
    """
    numbers = stage(quality.with_counts(docs).select("doc_id", "lang", *quality.COUNTS), "pipeline-counts")
    cutoffs = quality.certified_cutoffs(numbers, _table(spark, sf_dir, "labels"))
    # Counting twice moves less than keeping a second copy of all texts.
    return quality.judged(quality.with_counts(docs), cutoffs).where("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints of four-word shingles are linked by 4 differing bits or fewer.

    The smallest doc_id of a group stays, null last, and one of repeated rows.
    Null, empty and blank texts are copies of each other. An empty table stays
    empty, and columns of any name pass through.
    """
    return simhash.deduplicated(docs, simhash.SHINGLE, simhash.RADIUS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in which no benchmark item is found.

    Null and empty texts hold none and stay, repeated rows fare alike, texts of
    any length are searched whole. An empty table stays empty, an empty
    benchmark leaves all rows. Columns of any name pass through.
    """
    return decontaminate.decontaminated(docs, _table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's share of the mix asks for.

    A null source is one of the sources. Null and empty texts have size 0 and
    no target of their own; equal rows share their draw. An empty table stays
    empty, and columns of any name pass through.
    """
    return mixing.mix(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in a random order, with shard and slot.

    Every row is placed once, whatever its columns hold; equal rows are told
    apart by their number. Counts of the shards differ by one at most. An empty
    table stays empty; columns named shard or slot are replaced.
    """
    return sharding.shard(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("shards", shards),
]

# Fingerprints, edit distances and random draws have no SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
