"""A corpus pipeline in five stages, each calling one operator of spanforge.llm.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next stage's
docs. All but the last return the columns of documents. Further columns, whatever their names and types, come through
all stages but the last unchanged; rows are judged one by one, so null and repeated ids lose no row that another one's
text would cost them; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.llm import decontam, nearcopies, packing, quality, superkmers
from spanforge.llm.idcodec import shared_folder
from spanforge.session import table

#: Near copies share 4 of 5 of their five-word shingles or more (Jaccard), verified exactly. Candidates come from
#: fingerprints of word pairs within 6 bits and, as those miss many, from bands of minimum hashes.
NEAR_WORDS, NEAR_SIMILARITY = 5, (4, 5)
NEAR_SHINGLE, NEAR_RADIUS = 2, 6


def _held(docs: DataFrame) -> DataFrame:
    """Id, text and the other columns as one, so that no name of an operator clashes with a column."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*rest).alias("_row"))


def _freed(held: DataFrame, columns: list[str], **new) -> DataFrame:
    new |= {c: F.col(c) for c in ("doc_id", "text")}
    return held.select(*[new.get(c, F.col("_row").getField(c)).alias(c) for c in columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a structural rule, or whose log-likelihood ratio lies under the threshold, go. Null and empty
    texts fail for want of words; repeated rows share their fate."""
    judged = quality.judge_quality(_held(docs), table(spark, sf_dir, "labels"), keep=["doc_id", "text", "_row"])
    return _freed(judged.where("kept"), docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that of the smallest id, one without an id only where none has
    one. Wordless texts are copies of each other; of rows that repeat id and text one stays."""
    return _freed(nearcopies.drop_near_copies(_held(docs), NEAR_WORDS, NEAR_SIMILARITY, NEAR_SHINGLE, NEAR_RADIUS), docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of windows that an earlier document holds go, and ``n_chars`` follows; documents that lose all their words,
    or had none, go too."""
    cut = superkmers.dedup_text(_held(docs)).where("n_removed < n_words")
    return _freed(cut, docs.columns, n_chars=F.length("text").cast(docs.schema["n_chars"].dataType))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, with all rows of their id; rows without an id stay."""
    return _freed(decontam.decontaminate(_held(docs), table(spark, sf_dir, "benchmark")), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed training sequences, by checksum; an empty text is its end id alone."""
    return packing.pack_digest(docs, length=1024, end_id=0)


STAGES = [("quality rules", quality_rules), ("SimHash near-dedup", near_dedup), ("substring dedup", substring_dedup), ("benchmark decontamination", decontamination), ("packing", pack)]

#: Hashed n-gram models, components over fingerprints and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        folder = shared_folder(spark, "stage-" + name.replace(" ", "-").lower())
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
