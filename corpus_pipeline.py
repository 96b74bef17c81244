"""A corpus pipeline: toxicity, line dedup, near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablelift.llm.line_dedup import line_dedup
from tablelift.llm.mixing import in_mix_order
from tablelift.llm.near_duplicates import one_of_each
from tablelift.llm.packing import pack
from tablelift.llm.queries import WORD_VOCABULARY, vocabulary
from tablelift.llm.tables import scratch
from tablelift.llm.toxicity import toxicity_of
from tablelift.session import fresh_dir

# Documents with this share of their five-word shingles in common, or more, are near copies.
NEAR_PERCENT = 80


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity chain does not reject.

    Rows with a null or repeated doc_id are judged each by its text; a null text is judged as
    an empty one. Columns of any name are returned as they are.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    own = {name: f"__own_{name}" for name in docs.columns if name not in ("doc_id", "text")}
    judged = toxicity_of(docs.withColumnsRenamed(own), labels).where(~F.col("toxic"))
    return judged.select(*[F.col(f"`{own.get(name, name)}`").alias(name) for name in docs.columns])


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the later copies of runs of lines."""
    return line_dedup(docs).select(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, the one with the smallest doc_id."""
    return one_of_each(docs, NEAR_PERCENT)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, sorted in the order of the mix; repeated rows and null ids or sources too."""
    return in_mix_order(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of tokenized documents with their places in the training sequences.

    Files are not read in the order they were written in, so the order of the mix, which
    depends on the documents alone, is made again. Each task then packs a range of slots,
    and sequences are numbered by task. A null text is the end id alone.
    """
    return pack(in_mix_order(docs), vocabulary(WORD_VOCABULARY))


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", without_near_copies),
    ("mixing", mixed),
    ("packing", packed),
]

# Its classifier, sketches and packing have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages; what a stage writes on the way goes when it is done."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = fresh_dir(spark, f"pipeline-{name}")
        with scratch(spark):
            found = stage(spark, docs, sf_dir)
            found.write.parquet(folder)
        docs = spark.read.schema(found.schema).parquet(folder)
    return docs
