"""A training corpus from ``documents``: every stage calls one operator of cartero.llm.

Each stage gets what its predecessor kept and returns the columns of its input; the last
returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartero.llm import common, decontaminate, langid, minhash, packing, queries, winnow

PASSAGE_WORDS = 50  # one or two lines of more words count as a run of lines
LEAST_CERTAIN = 0.5  # a language is rejected if it is not likelier than all others together


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID (4): texts without letters (null ones too), or of no certain language, go; ids do not matter."""
    common.ship(spark)
    rows = docs.select("text", F.struct(*docs.columns).alias("_row"))
    found = langid.predict(rows, queries.language_model(spark, docs), ("_row",))
    return found.filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_CERTAIN)).select("_row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup (9): later runs of lines and passages go, and documents that were nothing else.

    Rows without an id and null texts stay as they are; rows that repeat an id keep what none of them has earlier.
    """
    common.ship(spark)
    rest = F.struct(*[c for c in docs.columns if c != "text"]).alias("row")
    cut = winnow.delete_runs(docs.select("doc_id", "text", rest), words=PASSAGE_WORDS)
    changed = F.col("lines_removed") > 0
    cut = cut.filter(~changed | (F.trim(F.regexp_replace("text", r"\s+", " ")) != "")).select(changed.alias("changed"), "text", "row")
    columns = {c: F.col("row")[c] for c in docs.columns if c != "text"} | {"text": F.col("text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        columns["n_chars"] = F.when(F.col("changed"), F.length("text").cast(kind)).otherwise(F.col("row")["n_chars"])
    return cut.select(*[columns[c].alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup (8): the smallest id of every group stays.

    Rows without an id pass.  Of rows that repeat an id, those of one text are one document; another
    text of the id is a document of its own, after all others, and goes only if it is linked to one.
    """
    common.ship(spark)
    return minhash.first_of_groups(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination (2): contaminated documents go; null texts, null ids and repeated rows are judged row by row."""
    common.ship(spark)
    return decontaminate.remove_documents(docs, common.table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing (10): the pieces of all rows in sequences of 1024 tokens; a null text is one end id, a null id is carried."""
    common.ship(spark)
    return packing.pack(docs, queries.tokenizer_path())


STAGES = [("language ID", language), ("line dedup", lines), ("MinHash near-dedup", near_duplicates),
          ("benchmark decontamination", benchmark), ("packing", pack)]
ORACLE_SQL = None  # SQL cannot state the learnt language model


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage is written and read again by the next."""
    docs = common.table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = common.stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
