"""TF-IDF features as a long table.

All functions work on stacks of corpora: ``modelo`` names the corpus (language,
fold, grid cell), so one set of jobs trains or scores all of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartero.functions import lexicons as lx
from cartero.functions import terms as in_tasks
from cartero.functions import text as tx
from cartero.functions.expressions import BROADCAST_ROWS, bounded_broadcast
from cartero.operators.ranking import top_per_group

MODEL = "modelo"
ID = "message_id"
MAX_FEATURES = 20_000


def stop_words(language: str) -> list[str]:
    """The fixed list of the vectoriser for English, of the domain for Spanish."""
    return list(lx.STOP_WORDS_ES if language == "es" else lx.STOP_WORDS_EN)


def terms(clean: Column, stop: list[str], ngram: int) -> Column:
    return tx.ngrams(tx.model_tokens(clean, stop), ngram)


def featurise(df: DataFrame, text: str, model: str, stop: list[str], ngram: int,
              carry: tuple[str, ...] = ("Label_Code", "parte")) -> DataFrame:
    """(modelo, id, carried columns, ``rasgos`` array<struct<term, cnt>>), one row per mail."""
    kept = [c for c in carry if c in df.columns]
    rows = df.select(F.struct(ID, *kept).alias("_row"), F.col(text).alias("_t"))
    schema = T.StructType([rows.schema["_row"], *T.StructType.fromDDL(in_tasks.COUNTS)])
    out = rows.mapInArrow(in_tasks.counter(tx.plain_stop_words(stop), ngram), schema)
    return out.select(F.lit(model).alias(MODEL), "_row.*", "rasgos")


def long_counts(features: DataFrame, *carry: str) -> DataFrame:
    """(modelo, id, carried, term, cnt)."""
    return features.select(MODEL, ID, *carry, F.inline("rasgos"))


def by_key(features: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(mails whose key occurs once, mails that share their key with others or None if there are none)."""
    again = features.groupBy(MODEL, ID).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(
        F.col(MODEL).alias("_m"), F.col(ID).alias("_i"))
    if again.isEmpty():
        return features, None
    same = F.col(MODEL).eqNullSafe(F.col("_m")) & F.col(ID).eqNullSafe(F.col("_i"))
    return features.join(again, same, "left_anti"), features.join(again, same, "left_semi")


def vocabulary(features: DataFrame, max_features: int = MAX_FEATURES) -> DataFrame:
    """(modelo, term, total, df, idf, rango): most frequent terms, ties by term."""
    n = features.groupBy(MODEL).agg(F.count(F.lit(1)).alias("_n"))
    freq = long_counts(features).groupBy(MODEL, "term").agg(
        F.sum("cnt").alias("total"), F.count(F.lit(1)).alias("df"))
    return ranked_vocabulary(freq, n, max_features)


def ranked_vocabulary(freq: DataFrame, n: DataFrame, max_features: int) -> DataFrame:
    """The vocabulary of counted terms (modelo, term, total, df) and mails (modelo, _n)."""
    top = top_per_group(freq, MODEL, "total", "term", max_features)
    idf = F.log((1.0 + F.col("_n")) / (1.0 + F.col("df"))) + 1.0
    return top.join(n, MODEL).select(MODEL, "term", "total", "df", idf.alias("idf"), "rango")


def tfidf(features: DataFrame, vocab: DataFrame, max_rows: int, *carry: str, norm: str | None = None,
          in_place: bool = False) -> DataFrame:
    """(modelo, id, carried, term, x) with (1 + ln cnt) * idf and L2-normalised mails; ``norm`` names a column for the lengths.

    Mails are dealt out as one row each before they are taken apart, so the
    norm of a mail needs no exchange of term rows.  With ``in_place`` the vocabulary is sent to every task and
    no mail moves; mails that share their key have one length and are dealt out, as all are by more than BROADCAST_ROWS terms.
    """
    if in_place and max_rows <= BROADCAST_ROWS:
        once, shared = by_key(features)
        out = _weighed(once, vocab, carry).select(MODEL, ID, *carry, "term", "x", *([F.col("norma").alias(norm)] if norm else []))
        return out if shared is None else out.unionByName(tfidf(shared, vocab, max_rows, *carry, norm=norm))
    side = bounded_broadcast(vocab.select(MODEL, "term", "idf"), max_rows)
    raw = long_counts(features.repartition(MODEL, ID), *carry).join(side, [MODEL, "term"]).withColumn(
        "x", (1.0 + F.log(F.col("cnt").cast("double"))) * F.col("idf"))
    length = F.sqrt(F.sum(F.col("x") * F.col("x")).over(Window.partitionBy(MODEL, ID)))
    return raw.select(MODEL, ID, *carry, "term", (F.col("x") / length).alias("x"), *([length.alias(norm)] if norm else []))


def _weighed(features: DataFrame, vocab: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    """(modelo, id, carried, term, x, norma) of mails that are weighted where they are."""
    rows = features.select(F.struct(MODEL, ID, *carry).alias("_row"), MODEL, "rasgos")
    schema = T.StructType([rows.schema["_row"], *T.StructType.fromDDL(in_tasks.WEIGHTS)])
    sent = features.sparkSession.sparkContext.broadcast(term_arrays(vocab, ["idf"]))
    return rows.mapInArrow(in_tasks.weigher(sent), schema).select("_row.*", "term", "x", "norma")


def term_arrays(table: DataFrame, columns: list[str]) -> dict[str, tuple[pa.Array, np.ndarray]]:
    """model -> (terms, values per term and column) of a table that parameters bound; null is NaN."""
    found: dict[str, list] = {}
    for r in table.select(MODEL, "term", *columns).collect():  # at most BROADCAST_ROWS rows
        found.setdefault(r[0], []).append(r[1:])
    return {m: (pa.array([r[0] for r in rows], pa.string()),
                np.array([[np.nan if x is None else x for x in r[1:]] for r in rows], float))
            for m, rows in found.items()}
