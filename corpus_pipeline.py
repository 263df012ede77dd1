"""The training-data pipeline over ``documents``: five stages, each over all rows its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each as
Parquet and reads it again for the next one. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill.llm import exact_dedup, jaccard, language, packing, pii, tagger
from ticketmill.llm.common import stored, table
from ticketmill.llm.queries import WORD_MODEL, tokenizer_file

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Stages on word shingles take five words and a similarity of 0.8.
NEAR = jaccard.Rule(width=5, num=80, den=100)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those without letters and those far from all languages go."""
    found = language.identified(docs)
    return found.filter(~F.col("rejected")).select(*docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id stays."""
    return exact_dedup.drop_copies(docs)


def _row_key(doc_id: str, text: str) -> Column:
    """A row's id and the hash of its text, in the order of the ids; null comes last."""
    digits = lambda c: F.lpad(F.hex(c), 16, "0")
    number = F.col(doc_id).cast("long").bitwiseXOR(F.lit(-(1 << 63)))
    place = F.concat(F.when(F.col(doc_id).isNull(), "01").otherwise("00"), digits(F.coalesce(number, F.lit(0))))
    return F.unhex(F.concat(place, digits(F.xxhash64(text))))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked texts the row with the smallest id stays.

    Rows are told apart by id and text: of an id with several texts each row is judged on
    its own, and of a group's rows with one id that with the least hash of its text stays.
    Rows equal in both, which the stage before leaves none of, stay or go together.
    """
    rows = docs.withColumn("_row", _row_key("doc_id", "text"))
    groups = stored(jaccard.components(rows, key="_row", rule=NEAR), "groups")
    copies = groups.filter("_row <> component_id").select("_row").distinct()
    return rows.join(copies, "_row", "left_anti").select(*docs.columns)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; n_chars is the new length."""
    masked = docs.withColumn("text", pii.masked("text", tagger.trained()))
    return masked.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their place in sequences of 4096 tokens."""
    return packing.packed_documents(docs, tokenizer_file(WORD_MODEL))


STAGES: list[tuple[str, Stage]] = [
    ("language id", known_language),
    ("exact dedup", without_copies),
    ("n-gram jaccard join", without_near_copies),
    ("pii", without_personal_data),
    ("best-fit packing", packed),
]

# Neither trained models nor tokenizers can be written as SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
