"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read back by the next.

Stages before the last return the columns of documents. Every row has a number of its
own, written with it when the documents are read (a stage that gets rows without numbers
writes them itself), and what a stage rejects it names by that: rows without a doc_id are
judged as the others are, and of rows with one doc_id each is judged by its own text. The
rejected are few next to the kept: they are counted, and sent to the tasks only
under a byte bound, so that no text is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm import decontaminate, language_id, near_dup, packing, secret_scan
from wardline.llm.common import broadcast_if_small, materialise, table


NUMBER = "_row_number"


def _numbered(docs: DataFrame) -> DataFrame:
    return docs if NUMBER in docs.columns else materialise(docs.withColumn(NUMBER, F.monotonically_increasing_id()), "numbered")


def _by_number(numbered: DataFrame) -> DataFrame:
    """The texts, for an operator, with the row's number as the id."""
    return numbered.select(F.col(NUMBER).alias("doc_id"), "text")


def _without(numbered: DataFrame, rejected: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """The rows but those whose numbers are in the column doc_id of ``rejected``."""
    gone = materialise(rejected.select(F.col("doc_id").alias(NUMBER)), name)
    return numbered.join(broadcast_if_small(gone, gone.count(), 16), NUMBER, "left_anti").select(*[F.col(f"`{c}`") for c in columns])


#: Languages that stay (None: every language that the labelled documents teach), and the least share of a text's
#: letters that its language must have.
LANGUAGES: tuple[str, ...] | None = None
LEAST_SCORE = 0.0


def language(spark: SparkSession, docs: DataFrame, sf_dir: str, keep: tuple[str, ...] | None = LANGUAGES, least_score: float = LEAST_SCORE) -> DataFrame:
    """Documents whose predicted language is one of ``keep`` with at least that score; those without a letter have none and go."""
    model = language_id.learn_model(docs, F.lit(True))
    if not model.labels:  # nothing to judge by
        return docs
    numbered = _numbered(docs)
    found = language_id.detect(_by_number(numbered), model, runs=False)
    kept = F.col("lang_pred").isin(*(model.labels if keep is None else keep)) & (F.col("score") >= least_score)
    return _without(numbered, found.where(~kept), "no-language", docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, and one of rows that repeat an id and its text."""
    numbered = _numbered(docs)
    found = near_dup.near_duplicates(_by_number(numbered)).select(F.col("doc_id").alias(NUMBER), "n_shingles", "component_id")
    blank = F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.col("text"))  # without words: only the same id and text repeat
    rows = found.join(numbered.select(NUMBER, F.col("doc_id").alias("id"), blank.alias("blank")), NUMBER)
    has_words = F.col("n_shingles") > 0
    rows = rows.where(has_words | F.col("id").isNotNull()).select(
        F.when(has_words, F.col("component_id")).alias("component"), F.when(~has_words, F.col("id")).alias("same"), "blank",
        F.struct(F.col("id").isNull().alias("no_id"), "id", NUMBER).alias("row"))
    rows = materialise(rows, "groups")
    # the smallest doc_id stays, then the first row
    first = rows.groupBy("component", "same", "blank").agg(F.min("row").alias("row")).select(F.col(f"row.{NUMBER}").alias("doc_id"))
    again = rows.select(F.col(f"row.{NUMBER}").alias("doc_id")).join(first, "doc_id", "left_anti")
    return _without(numbered, again, "near-duplicates", docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item."""
    numbered = _numbered(docs)
    found = decontaminate.decontaminate(_by_number(numbered), table(spark, sf_dir, "benchmark"))
    return _without(numbered, found.where("contaminated"), "contaminated", docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts masked."""
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token sequences of what is left."""
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", pack),
]

#: Stages with a learned model or a tokenizer are beyond SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows."""
    docs = _numbered(table(spark, sf_dir, "documents"))
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
