"""Corpus pipeline: stages over ``documents``, each written as Parquet and read again.

toxicity -> line dedup -> MinHash near-dedup -> mixing to target weights ->
best-fit packing. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import line_dedup, mixing, packing, setsketch, toxicity
from martloom.llm.common import table, unused
from martloom.llm.queries import shipped, tokenizer_path
from martloom.session import checkpoint_dir

NEAR = 80  # per cent of the union of two documents' word shingles that makes them near-duplicates


# Columns of the documents pass through every stage but the last under their own names, whatever these are.


@shipped
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier does not reject.

    NULL and empty texts hold no word and stay; texts are scored whole; a score
    of exactly 0.5 rejects; repeated rows fare alike; columns named as the
    classifier's are kept as they were. An empty table gives no rows.
    """
    own = ("score", "predicted")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    plain = docs.withColumnsRenamed({c: f"own {c}" for c in own if c in docs.columns})
    kept = toxicity.predict(plain, model).filter("predicted = 0")
    return kept.select(*[F.col(f"`own {c}`").alias(c) if c in own else F.col(c) for c in docs.columns])


@shipped
def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs deleted; documents left without a word by that go.

    NULL texts stay NULL, empty ones empty; texts are read whole; ``n_chars``
    follows the text; of rows that repeat id and text none is a copy of the
    other. An empty table gives no rows.
    """
    counts = ("n_lines", "n_deleted", "n_left")
    plain = docs.withColumnsRenamed({c: f"own {c}" for c in counts if c in docs.columns})
    cut = line_dedup.dedup_lines(plain).filter("n_deleted = 0 OR n_left > 0")
    if "n_chars" in docs.columns:
        length = F.when(F.col("n_deleted") > 0, F.length("text")).otherwise(F.col("n_chars"))
        cut = cut.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))
    return cut.select(*[F.col(f"`own {c}`").alias(c) if c in counts else F.col(c) for c in docs.columns])


def _marked(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a hash of the text, and the name of that column."""
    mark = unused(docs.columns, "_mark")
    return docs.withColumn(mark, F.xxhash64("text")).alias("d"), mark


def _same_document(mark: str):
    return F.expr(f"d.doc_id <=> o.doc_id AND d.`{mark}` = o.mark")


@shipped
def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of the smallest id.

    Documents without words (NULL texts too) are near nothing and stay; texts
    are compared whole; of rows that repeat id and text one stays; of a group
    without any id one. An empty table gives no rows.
    """
    kept = setsketch.near_duplicates(docs, link=NEAR).filter("kept").select("doc_id", "mark").alias("o")
    marked, mark = _marked(docs)
    return marked.join(kept, _same_document(mark), "left_semi").select(*docs.columns).dropDuplicates(["doc_id", "text"])


@shipped
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, twice at most.

    NULL sources are one source; documents without words (NULL texts too) take
    no budget; texts are counted whole; ties of the key go by id, then size;
    rows that repeat id and text are taken equally often. An empty table gives
    no rows.
    """
    taken = mixing.mix(mixing.quality_weight(mixing.sized(docs), table(spark, sf_dir, "labels")), carry=["mark"])
    copies = taken.groupBy("doc_id", "mark").agg(F.max("copies").cast("int").alias("copies")).filter("copies > 0").alias("o")
    repeated = F.explode(F.sequence(F.lit(1), F.col("o.copies")))
    marked, mark = _marked(docs)
    return marked.join(copies, _same_document(mark)).select(
        "d.*", repeated.alias(unused([*docs.columns, mark], "_copy"))).select(*docs.columns)


@shipped
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences.

    NULL and empty texts are the end id alone; long texts are cut into full
    pieces; every row is a document of its own; other columns are not needed.
    An empty table gives no rows.
    """
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("near dedup", dedup_near),
    ("mixing", mix_sources),
    ("packing", pack),
]
ORACLE_SQL = None  # the classifier, the verified near-duplicates and the tokenizer have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each over all rows its predecessor kept."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{at}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
