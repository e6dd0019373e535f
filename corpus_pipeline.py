"""Corpus pipeline: documents through quality rules, line and near-duplicate removal, decontamination
and piece encoding. Each stage reads what the one before has written."""

from logweir.llm import decontam, lines, near, pieces, quality
from logweir.llm.common import stored


def quality_rules(spark, docs, sf_dir):
    """Documents that fail a rule go."""
    return quality.keep_good(docs)


def line_dedup(spark, docs, sf_dir):
    """Lines found on many sites go, but for their first place."""
    return lines.without_boilerplate(docs)


def near_dedup(spark, docs, sf_dir):
    """One document of each group of near-duplicates stays."""
    return near.one_of_each(docs)


def decontamination(spark, docs, sf_dir):
    """Documents that hold a benchmark item go."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def piece_encoding(spark, docs, sf_dir):
    """The documents with sampled piece ids, and the text those ids decode to."""
    return pieces.round_trip(docs, "piece_ids", "decoded")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("piece_encoding", piece_encoding),
]

#: Connected groups of near-duplicates and seeded piece sampling have no SQL form.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages applied to the documents, each written as a table before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
