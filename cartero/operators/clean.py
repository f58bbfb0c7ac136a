"""Corpus cleaning: labels, exact copies, length limits, audit counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartero.functions import text as tx
from cartero.functions.expressions import text_key
from cartero.sources.mail import keep_present, resolve_aliases

ID = "message_id"


def drop_null_text(df: DataFrame, column: str = "Message") -> DataFrame:
    return df.na.drop(subset=[column])


def null_profile(df: DataFrame) -> DataFrame:
    """(columna, nulos) in one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "columna", "nulos")


def category(df: DataFrame, label_first: bool = False) -> Column:
    """ham/spam from ``label_text`` (text or code), repaired from ``label``; null if neither tells."""
    from_code = from_text = F.lit(None).cast("string")
    if "label" in df.columns:
        from_code = F.when(F.col("label") == 0, "ham").when(F.col("label") == 1, "spam")
    if "label_text" in df.columns:
        raw = F.lower(F.col("label_text"))
        from_text = (F.when(raw.isin("0", "ham"), "ham").when(raw.isin("1", "spam"), "spam"))
    elif "Category" in df.columns:
        from_text = F.col("Category")
    return F.coalesce(from_code, from_text) if label_first else F.coalesce(from_text, from_code)


def label_code(cat: Column) -> Column:
    return F.when(cat == "ham", 0).when(cat == "spam", 1)


def normalise_label(df: DataFrame, label_first: bool = False) -> DataFrame:
    return (df.withColumn("Category", category(df, label_first))
            .withColumn("Label_Code", label_code(F.col("Category"))))


def unlabelled(df: DataFrame) -> DataFrame:
    """Rows whose label cannot be told (the rejects of ``normalise_label``)."""
    return normalise_label(df).filter(F.col("Category").isNull())


def with_length(df: DataFrame) -> DataFrame:
    return df.withColumn("longitud_correo", tx.char_count(F.col("Message")))


def keepers(df: DataFrame, ident: str = ID, column: str = "Message") -> DataFrame:
    """(clave, first id, copies) of every distinct text.

    Copies are merged map-side on a 16-byte key with fixed-size buffers, so a
    text that makes up a third of the corpus costs each task one row.
    """
    return (df.select(text_key(F.col(column)).alias("clave"), F.col(ident))
            .groupBy("clave").agg(F.min(ident).alias(ident), F.count(F.lit(1)).alias("copias")))


def dedupe_exact(df: DataFrame, ident: str = ID, column: str = "Message") -> DataFrame:
    """Keep the first row (smallest id) per exact text.

    The survivors are joined back on the unique id, never on the text, so no
    group of copies meets in one task.
    """
    first = keepers(df, ident, column).select(ident)
    return df.join(first, ident, "left_semi")


def duplicate_report(df: DataFrame, column: str = "Message") -> DataFrame:
    k = keepers(df, column=column)
    return k.agg(F.sum("copias").alias("filas"), F.count(F.lit(1)).alias("distintos"),
                 F.sum(F.col("copias") - 1).alias("duplicados"))


def min_length(df: DataFrame, column: str = "longitud_correo", above: int = tx.MIN_CHARS) -> DataFrame:
    return df.filter(F.col(column) > above)


def truncate_long(df: DataFrame, limit: int = tx.MAX_CHARS, keep_length: bool = False) -> DataFrame:
    """Cut over-long mails and flag them; the held-out variant keeps the old length."""
    long_ = F.col("longitud_correo") > limit
    out = df.withColumn("truncado", long_.cast("int")).withColumn(
        "Message", F.when(long_, F.substring("Message", 1, limit)).otherwise(F.col("Message")))
    if keep_length:
        return out
    return out.withColumn("longitud_correo", F.least(F.col("longitud_correo"), F.lit(limit)))


def labelled(df: DataFrame) -> DataFrame:
    """Rows with text and label: ``Message``, ``Category``, ``Label_Code``, ``longitud_correo``."""
    rows = normalise_label(drop_null_text(resolve_aliases(df)))
    return with_length(rows.na.drop(subset=["Category"]))


def clean_corpus(df: DataFrame, max_chars: int | None = None) -> DataFrame:
    """The whole cleaning stage; mails are cut only if ``max_chars`` is given."""
    rows = min_length(dedupe_exact(labelled(df)))
    return keep_present(rows if max_chars is None else truncate_long(rows, max_chars))


def long_mail_bias(df: DataFrame, limit: int = tx.MAX_CHARS) -> DataFrame:
    """Class counts of over-long mails, after removing copies and before cutting."""
    rows = dedupe_exact(labelled(df)).filter(F.col("longitud_correo") > limit)
    return rows.groupBy("Category").agg(F.count(F.lit(1)).alias("conteo"))


def cleaning_funnel(df: DataFrame) -> DataFrame:
    """(etapa, conteo, porcentaje) of the cleaning stage.

    Rows are folded to one per distinct text first, which gives the distinct
    counts without a second shuffle.
    """
    rows = normalise_label(resolve_aliases(df))
    valid = F.col("Message").isNotNull() & F.col("Category").isNotNull()
    per_text = (rows.select(text_key(F.col("Message")).alias("clave"),
                            F.length("Message").alias("n"), valid.alias("valid"))
                .groupBy("clave").agg(F.count(F.lit(1)).alias("filas"), F.max("n").alias("n"),
                                      F.max(F.col("valid").cast("int")).alias("valid")))
    ok = F.col("valid") == 1
    totals = per_text.agg(
        F.sum("filas").alias("inicial"),
        F.sum(F.when(F.col("clave").isNotNull(), F.col("filas")).otherwise(0)).alias("sin_nulos"),
        F.count_if(ok).alias("sin_dup"),
        F.count_if(ok & (F.col("n") > tx.MIN_CHARS)).alias("final"),
        F.count_if(ok & (F.col("n") > tx.MAX_CHARS)).alias("truncados"))
    steps = ["inicial", "sin_nulos", "sin_dup", "final", "truncados"]
    pairs = F.array(*[F.struct(F.lit(s).alias("etapa"), F.col(s).alias("conteo")) for s in steps])
    return totals.select(F.col("inicial").alias("_n"), F.inline(pairs)).select(
        "etapa", "conteo", F.round(F.col("conteo") * 100.0 / F.col("_n"), 1).alias("porcentaje"))


def heldout_corpus(df: DataFrame, max_chars: int | None = None) -> DataFrame:
    """Cleaning of an unseen split: code label first, no copy removal, original length kept; cut only if ``max_chars`` is given."""
    rows = normalise_label(drop_null_text(resolve_aliases(df)), label_first=True)
    rows = with_length(rows.na.drop(subset=["Category"]))
    rows = min_length(rows)
    return keep_present(rows if max_chars is None else truncate_long(rows, max_chars, keep_length=True))


def class_distribution(df: DataFrame, column: str = "Category") -> DataFrame:
    """(class, count, % with one decimal); the window runs over the few classes only."""
    n = df.groupBy(column).agg(F.count(F.lit(1)).alias("conteo"))
    total = F.sum("conteo").over(Window.partitionBy())
    return n.withColumn("porcentaje", F.round(F.col("conteo") * 100.0 / total, 1))
