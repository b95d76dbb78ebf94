"""From raw documents to token ids: five stages, each over all that the one before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivalry.llm import decontaminate, pieces, pii, quality, similar
from rivalry.llm.queries import KEY, MODEL, table
from rivalry.session import drop_stored, stored, stored_so_far


#: Rows that Spark sends to a Python worker together; texts are large.
BATCH = 1_000


def bound_batches(spark: SparkSession) -> None:
    """Let batches of texts be small in the executors' memory, beside the heap and the workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose chance of the best grade suffices.

    Null and empty texts are rated like any other; repeated rows stay or go together; an empty
    table, or one without labels, gives what :func:`quality.fit` states. Other columns stay.
    """
    bound_batches(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    rated = quality.select(quality.rate(docs, model))
    return rated.where("kept").select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicate texts the document of least id; see ``one_per_class`` on nulls,
    repeats and empty tables."""
    bound_batches(spark)
    return similar.one_per_class(docs)


def keep_unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    bound_batches(spark)
    return decontaminate.decontaminate_rows(docs, table(spark, sf_dir, "benchmark"))


def hide_persons(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data; n_chars follows the text.

    Null texts stay null with their n_chars; repeated rows get equal texts; an empty table stays so.
    """
    changed = pii.replace(docs, KEY)
    n_chars = F.when(F.col("n_entities") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return changed.withColumn("n_chars", n_chars).select(*docs.columns)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids, n_ids, exact: null ids for a null text, none for an empty one."""
    bound_batches(spark)
    return pieces.encode(docs, pieces.Vocabulary.load(MODEL)).drop("text", "n_chars")


STAGES = [
    ("quality", keep_good),
    ("similar", keep_one_of_each),
    ("decontaminate", keep_unleaked),
    ("pii", hide_persons),
    ("pieces", to_pieces),
]

#: No SQL: a fitted model, hashed shingles and keyed surrogates are none of its functions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents of ``sf_dir``, each result written and read again.

    What a stage has stored on its way goes as soon as its result is written, raw personal data
    with it, and so does the result that it read.
    """
    docs = table(spark, sf_dir, "documents")
    begun = stored_so_far()
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
        drop_stored(spark, begun, -1)
    return STAGES[-1][1](spark, docs, sf_dir)
