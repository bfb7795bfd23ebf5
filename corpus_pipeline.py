"""Corpus pipeline: language ID, near-duplicates, decontamination, source mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
every stage's result as Parquet in the shared checkpoint folder and gives the
next stage what it reads back.  All stages but the last return the columns of
documents; the last adds shard and slot.

Columns beside those of the documents table travel as one struct, so an
operator's column of the same name cannot take their place; the last stage
returns them under their own names, but ``own_<name>`` where an output column
has that name.

Null, empty and very long texts, repeated rows and empty tables are handled
as the operators say: letterless texts go in the first stage (their language
is unknown), one row of each near-duplicate group stays (the least id; rows
repeated under it count once), mixing may repeat a document, and repeated
documents are separate rows of the shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.llm import decontaminate, langid, mixing, sharding, simhash
from ratelens.llm.common import fold, table, written
from ratelens.llm.params import MIN_LANGUAGE_SCORE, MIX_SEED, MIX_WEIGHTS, N_SHARDS


COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: columns that the last stage adds
ADDED = ("size", "text_crc32", "shard", "slot")
_OWN = "__own"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _others(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c.lower() not in COLUMNS]


def _packed(docs: DataFrame) -> DataFrame:
    """The documents' columns, and all others as one struct."""
    others = _others(docs)
    kept = [c for c in docs.columns if c.lower() in COLUMNS]
    return docs.select(*kept, F.struct(*[F.col(_quoted(c)) for c in others]).alias(_OWN)) if others else docs


def _unpacked(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` of the rows of ``out``, which were packed."""
    others = set(_others(docs))
    return out.select(*[F.col(f"{_OWN}.{_quoted(c)}") if c in others else F.col(c) for c in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts of no known language; the language column gets the prediction where it was null."""
    langs, proto = langid.train_prototypes(langid.training_rows(docs, fold("doc_id", 4) != 2))
    kept = langid.identify(_packed(docs), langs, proto).filter(
        (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE))
    return _unpacked(kept.withColumn("lang", F.coalesce("lang", "lang_pred")), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one whose id names the group."""
    return _unpacked(simhash.one_of_each(simhash.near_duplicates(_packed(docs))), docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item."""
    found = decontaminate.decontaminate(_packed(docs), table(spark, sf_dir, "benchmark"))
    return _unpacked(found.filter(~F.col("contaminated")), docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat documents to the sources' target weights, in global shuffle order."""
    return _unpacked(mixing.poisson_mix(_packed(docs), MIX_WEIGHTS, MIX_SEED), docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns plus size, text_crc32, shard and slot, in a seeded shuffle order that keeps copies apart."""
    out = sharding.shard_by_bytes(_packed(docs), N_SHARDS, seed=MIX_SEED)
    others = set(_others(docs))
    own = [F.col(f"{_OWN}.{_quoted(c)}").alias(f"own_{c}" if c.lower() in ADDED else c) if c in others else F.col(c) for c in docs.columns]
    return out.select(*own, *ADDED)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("sharding", shards),
]

#: The language model and the near-duplicate components have no SQL form; tests check every stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
