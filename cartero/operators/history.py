"""Feedback records, retraining catalogue and audit history.

``seq`` is the arrival number of an event and is unique.  Groups are formed on
the trimmed text; one text may hold a large part of all events, so groups are
merged map-side from fixed-size values (counts, first and last seq) and their
attributes are fetched by the unique seq afterwards.  A log may carry the key
``clave`` of the trimmed text in place of the text; no exchange moves a text per
event then, and ``texts`` (clave, texto) adds it to the rows of the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartero.functions import text as tx
from cartero.functions.expressions import compute_once, text_key

SEQ = "seq"
STRETCH = 1_000_000      # arrival numbers per stretch of the two-level numbering
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
PAGE_SIZES = (5, 10, 25, 50, "all")


def label_name(label: Column) -> Column:
    return F.when(label == 1, "SPAM").otherwise("HAM")


def percent(p: Column) -> Column:
    return F.round(p * 100, 1)


def _summary() -> Column:
    return F.when(F.length("texto") > tx.SUMMARY_CHARS, F.concat(
        F.substring("texto", 1, tx.SUMMARY_CHARS), F.lit("..."))).otherwise(F.col("texto"))


def with_texts(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Text and summary of rows that carry the key of their text."""
    return rows.join(texts.select("clave", "texto"), "clave").withColumn("texto_resumen", _summary())


def feedback_records(events: DataFrame, posterior: str = "p_posterior") -> DataFrame:
    """Event with the score after teaching -> full history record; blank texts are refused.

    Events with ``clave`` in place of ``texto`` give records without text and summary (``with_texts`` adds them).
    """
    before, after = percent(F.col("p_spam")), percent(F.col(posterior))
    delta = F.round(after - before, 1) + 0.0
    taught = label_name(F.col("label"))
    if "clave" in events.columns:
        rows, text = events, [F.col("clave")]
    else:
        rows = compute_once(events, texto=tx.sanitise(F.col("texto"))).filter(F.col("texto") != "")
        text = [F.col("texto"), _summary().alias("texto_resumen")]
    return rows.select(
        SEQ, "timestamp", *text, F.upper("idioma").alias("idioma"),
        F.col("pred_prev").alias("prediccion_previa"), F.col("p_spam").alias("probabilidad_spam_previa"),
        F.format_string("%.1f%%", before).alias("porcentaje_antes"),
        F.when(F.col(posterior) >= F.col("umbral"), "SPAM").otherwise("HAM").alias("prediccion_posterior"),
        F.col(posterior).alias("probabilidad_spam_posterior"),
        F.format_string("%.1f%%", after).alias("porcentaje_despues"),
        F.format_string("%+.1f%%", delta).alias("cambio_delta"), "umbral",
        taught.alias("etiqueta_ensenada"),
        F.coalesce(F.col("pred_prev") == taught, F.lit(False)).alias("era_correcto"))


def count_samples(events: DataFrame, priors: DataFrame, model: str = "modelo", stretch: int = STRETCH) -> DataFrame:
    """``num_muestras_total``: samples the taught model has seen with this event, training rows included."""
    seen = numbered(events.select(model, SEQ), [model], SEQ, stretch, "_nth").drop("_total", model)
    trained = priors.select(model, (F.col("n_ham") + F.col("n_spam")).alias("_trained"))
    return events.join(seen, SEQ).join(trained, model, "left").withColumn(
        "num_muestras_total", F.col("_nth") + F.coalesce("_trained", F.lit(0))).drop("_nth", "_trained")


def learning_log(records: DataFrame, clean: str = "texto_procesado") -> DataFrame:
    """Compact log of taught mails with the running number of samples."""
    return records.select(
        "timestamp", "idioma", label_name(F.col("label")).alias("etiqueta_asignada"),
        F.format_string("%.3f", "p_spam").alias("p_spam_previa"), "num_muestras_total",
        F.col("texto").alias("texto_original"), F.col(clean).alias("texto_procesado"))


def numbered(df: DataFrame, keys: list[str], order: str = SEQ, stretch: int = STRETCH,
             column: str = "numero") -> DataFrame:
    """Exact 1..n numbering inside each key by ``order``, without one task per key.

    Arrival numbers are cut into stretches; counts per (key, stretch) are
    prefix-summed and rows are numbered inside their stretch only.
    """
    cut = df.withColumn("_s", F.floor(F.col(order) / stretch))
    sizes = cut.groupBy(*keys, "_s").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select(*keys, "_s", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_b"),
                        F.sum("_n").over(Window.partitionBy(*keys)).alias("_total"))
    inside = Window.partitionBy(*keys, "_s").orderBy(order)
    return cut.join(base, [*keys, "_s"]).withColumn(
        column, F.col("_b") + F.row_number().over(inside)).drop("_s", "_b")


def _groups(log: DataFrame) -> DataFrame:
    key = F.col("clave") if "clave" in log.columns else text_key(tx.sanitise(F.col("texto"))).alias("clave")
    return log.select(key, SEQ).groupBy("clave").agg(
        F.count(F.lit(1)).alias("veces"), F.min(SEQ).alias("primero"), F.max(SEQ).alias("ultimo"))


def retrain_catalogue(events: DataFrame, posterior: str = "p_posterior", stretch: int = STRETCH,
                      texts: DataFrame | None = None) -> DataFrame:
    """One entry per text: ids in arrival order, first language and date, last label and score.

    Entries are numbered by key; the texts join afterwards.
    """
    rows = events
    if texts is None:
        rows = events.withColumn("texto", tx.sanitise(F.col("texto"))).filter(F.col("texto") != "")
        texts = rows.select(text_key(F.col("texto")).alias("clave"), "texto").dropDuplicates(["clave"])
    first = rows.select(F.col(SEQ).alias("primero"), F.upper("idioma").alias("idioma"), F.col("timestamp").alias("fecha"))
    last = rows.select(F.col(SEQ).alias("ultimo"), "label", F.col("timestamp").alias("_fecha"),
                       F.col(posterior).alias("ultima_probabilidad_spam"))
    out = _groups(rows).join(first, "primero").join(last, "ultimo").withColumn("_all", F.lit(1))
    out = numbered(out, ["_all"], "primero", stretch).join(texts.select("clave", "texto"), "clave")
    return out.select(
        F.format_string("fb_%03d", "numero").alias("id"), "fecha", "idioma",
        label_name(F.col("label")).alias("etiqueta"), "label", "texto",
        F.col("veces").alias("veces_entrenado"),
        F.when(F.col("veces") > 1, F.col("_fecha")).alias("ultima_fecha"), "ultima_probabilidad_spam")


def history_groups(log: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """One row per text: number of records, first and last record by arrival."""
    g = _groups(log)
    last = log.select(F.col(SEQ).alias("ultimo"), *[c for c in log.columns if c not in (SEQ, "clave")])
    first = log.select(F.col(SEQ).alias("primero"), F.col("timestamp").alias("primera_fecha"))
    out = g.join(last, "ultimo").join(first, "primero")
    if texts is not None:
        out = with_texts(out, texts)
    when = F.coalesce(F.unix_timestamp(F.try_to_timestamp("timestamp", F.lit(TIME_FORMAT))), F.lit(0))
    return out.withColumn("tiempo", when).withColumn("insignia", F.col("veces") > 1)


def history_order() -> list[Column]:
    """Most recently updated text first, then by first arrival."""
    return [F.desc("tiempo"), F.asc("primero")]


def history_timeline(log: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """Every record with its iteration number inside its text's group."""
    rows = log if "clave" in log.columns else log.withColumn("clave", text_key(tx.sanitise(F.col("texto"))))
    places = numbered(rows.select("clave", SEQ), ["clave"], SEQ, stretch, "iteracion").drop("clave")
    return rows.join(places, SEQ).withColumn("es_actual", F.col("iteracion") == F.col("_total")).withColumn(
        "estado", F.when(F.col("era_correcto"), "Confirmado").otherwise("Reentrenado")).drop("_total")


def history_search(groups: DataFrame, query: str, fields: tuple[str, ...] = (
        "texto", "texto_resumen", "categoria", "idioma")) -> DataFrame:
    """Case-insensitive containment in any of the searched fields."""
    needle = query.strip().lower()
    if not needle:
        return groups
    cond = F.lit(False)
    for f in fields:
        if f in groups.columns:
            cond = cond | F.coalesce(F.lower(F.col(f)).contains(needle), F.lit(False))
    return groups.filter(cond)


def history_page(groups: DataFrame, page: int = 1, size: int | str = 10, stretch: int = STRETCH) -> DataFrame:
    """One page of the ordered history; the page number is clamped to the existing pages.

    Groups are counted per day, and inside the days that the page touches per
    second and stretch of arrival numbers; only rows of the cells that the page
    touches are sorted, so page p costs no more than page 1.
    """
    if size == "all":
        return groups.orderBy(*history_order())
    total = groups.count()
    pages = max(1, -(-total // int(size)))
    first = (min(max(1, page), pages) - 1) * int(size)

    def touched(sizes: DataFrame, order: Window) -> DataFrame:
        before = F.coalesce(F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        out = sizes.withColumn("_before", F.col("_start") + before)
        return out.filter((F.col("_before") < first + int(size)) & (F.col("_before") + F.col("_n") > first)).drop("_start", "_n")

    rows = groups.select("primero", "tiempo", F.floor(F.col("tiempo") / 86400).alias("_day"),
                         F.floor(F.col("primero") / stretch).alias("_s"))
    count = F.count(F.lit(1)).alias("_n")
    days = touched(rows.groupBy("_day").agg(count).withColumn("_start", F.lit(0)), Window.orderBy(F.desc("_day")))
    near = rows.join(days.withColumnRenamed("_before", "_start"), "_day")
    cells = touched(near.groupBy("_day", "_start", "tiempo", "_s").agg(count),
                    Window.partitionBy("_day").orderBy(F.desc("tiempo"), "_s"))
    inside = F.row_number().over(Window.partitionBy("_day", "tiempo", "_s").orderBy("primero"))
    ranked = near.join(cells, ["_day", "tiempo", "_s"]).withColumn("_rank", F.col("_before") + inside)
    wanted = ranked.filter((F.col("_rank") > first) & (F.col("_rank") <= first + int(size))).select("primero")
    return groups.join(wanted, "primero", "left_semi").orderBy(*history_order())
