"""Scores while a model is being taught: every event is scored by the model that has just learnt it.

Teaching adds to counts only, so the model after event e is the model before all events plus
the sums of what the events up to e have added.  Arrival numbers are cut into stretches: the counts at
the start of every stretch are prefix sums, and inside a stretch one task teaches its events in
order.  No term row moves per event, and the result does not depend on how events are cut into batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartero.functions import terms as in_tasks
from cartero.functions.expressions import BROADCAST_ROWS
from cartero.operators.bayes import NaiveBayes, class_sums
from cartero.operators.features import ID, MODEL, long_counts, term_arrays
from cartero.operators.score import routed_features, term_rules
from cartero.sources.mail import write_stage

STRETCH = 100_000  # arrival numbers whose rows of one key are summed by one task
EVENTS = 20_000    # arrival numbers of one model that one task teaches in order, with their texts and the model's counts
BLOCK = 1024       # terms whose counts at the start of all stretches one task adds up
CELLS = "i binary, cnt binary, norma double, masa double"


def running_sums(rows: DataFrame, keys: list[str], order: str, values: list[str], stretch: int = STRETCH) -> DataFrame:
    """Add ``run_<value>``: the sum of each value over the rows of the same keys up to this one, by ``order``.

    Two levels: sums per stretch of ``order`` are added up first, and rows are summed inside their
    stretch only, so a key that most rows share is summed by many tasks.  ``rows`` is
    read twice and should be a written stage.  ``order`` is unique within a key.
    """
    cut = rows.withColumn("_s", F.floor(F.col(order) / stretch))
    sums = cut.groupBy(*keys, "_s").agg(*[F.sum(v).alias(v) for v in values])
    earlier = Window.partitionBy(*keys).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(*keys, "_s", *[F.coalesce(F.sum(v).over(earlier), F.lit(0.0)).alias(f"_b_{v}") for v in values])
    inside = Window.partitionBy(*keys, "_s").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = cut.select("*", *[F.sum(v).over(inside).alias(f"_i_{v}") for v in values]).join(base, [*keys, "_s"])
    return out.select(*rows.columns, *[(F.col(f"_i_{v}") + F.col(f"_b_{v}")).alias(f"run_{v}") for v in values])


def text_cells(texts: DataFrame, before: NaiveBayes) -> tuple[DataFrame, DataFrame]:
    """(vocabulary, texts): the model's terms with a number, and per text its known terms with its length and mass.

    ``texts`` has one row per model and text (modelo, id = key of the text, texto_procesado).  The numbers and counts of
    a text's terms are bytes.  Terms are looked up where the text is; the terms of a larger model are joined.  Both are written stages.
    """
    number = (F.row_number().over(Window.partitionBy(MODEL).orderBy("term")) - 1).alias("i")     # max_rows terms at most
    vocab = write_stage(before.counts.select(MODEL, "term", "idf", "w_ham", "w_spam", number), "taught_vocab")
    if before.max_rows > BROADCAST_ROWS:
        cells = _cells_by_joins(texts, vocab)
    else:
        tables = {m: (terms.to_pylist(), idf[:, 0]) for m, (terms, idf) in term_arrays(vocab.orderBy(MODEL, "i"), ["idf"]).items()}
        sent = vocab.sparkSession.sparkContext.broadcast(tables)
        rows = texts.select(MODEL, ID, "texto_procesado")
        cells = rows.mapInArrow(in_tasks.mail_cells(sent, term_rules()), f"{MODEL} string, {ID} binary, {CELLS}")
    return vocab, write_stage(cells.withColumnRenamed(ID, "clave"), "taught_texts")


def _cells_by_joins(texts: DataFrame, vocab: DataFrame) -> DataFrame:
    """The same for models too large to be sent to every task."""
    flat = long_counts(routed_features(texts).repartition(MODEL, ID)).join(vocab.select(MODEL, "term", "idf", "i"), [MODEL, "term"])
    x = (1.0 + F.log(F.col("cnt").cast("double"))) * F.col("idf")
    norm = F.sqrt(F.sum(x * x))
    rows = flat.groupBy(MODEL, ID).agg(F.array_sort(F.collect_list(F.struct("i", "cnt"))).alias("_c"), norm.alias("norma"),
                                       (F.sum(x) / norm).alias("masa"))
    packed = rows.select(MODEL, ID, F.col("_c.i").alias("i"), F.col("_c.cnt").alias("cnt"), "norma", "masa")
    return packed.mapInArrow(_packed_lists(), f"{MODEL} string, {ID} binary, {CELLS}")


def _packed_lists():
    """Numbers and counts as bytes."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for name in ("i", "cnt"):
                lists = b.column(name)
                ends, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype("<i4")
                b = b.set_column(b.schema.get_field_index(name), name, pa.array(
                    [values[a:z].tobytes() for a, z in zip(ends, ends[1:])], pa.binary()))
            yield b

    return run


def weighted_events(events: DataFrame, cells: DataFrame) -> DataFrame:
    """Events (modelo, id = arrival number, Label_Code, clave) with ``peso`` and ``masa``, a written stage.

    An arrival number that occurs twice is one mail of both texts: their weights are scaled to a common length of one.
    """
    mail = Window.partitionBy(MODEL, ID)
    rows = events.join(cells.select(MODEL, "clave", "norma", "masa"), [MODEL, "clave"], "left").na.fill(0.0, ["norma", "masa"])
    rows = rows.withColumn("_l", F.sqrt(F.sum(F.col("norma") * F.col("norma")).over(mail)))
    rows = rows.withColumn("peso", F.when(F.col("_l") > 0, F.col("norma") / F.col("_l")).otherwise(0.0))
    return write_stage(rows.select(MODEL, ID, "Label_Code", "clave", "peso",
                                   F.sum(F.col("peso") * F.col("masa")).over(mail).alias("masa")), "taught_events")


def stretch_texts(events: DataFrame, cells: DataFrame, stretch: int = EVENTS) -> DataFrame:
    """(modelo, _s, clave, w_ham, w_spam, terms): the texts of every stretch and their weights by class, a written stage.

    ``events`` are ``weighted_events``, ``cells`` the texts of ``text_cells``.  The events of a text are added up first, and
    the rows of a stretch lie together.  Events without an arrival number are in the stretch null.
    """
    cut = events.withColumn("_s", F.floor(F.col(ID) / stretch))
    texts = class_sums(cut, [MODEL, "_s", "clave"], F.col("peso")).join(cells.drop("masa"), [MODEL, "clave"])
    return write_stage(texts.repartition(MODEL, "_s"), "taught_stretch_texts")


def stretch_gains(texts: DataFrame) -> DataFrame:
    """(modelo, _s, bloque, i, h, p): what the texts of a stretch add to the counts before the idf, a written stage.

    Terms come in blocks of ``BLOCK`` numbers, as lists of those that gain; the lists of one stretch may come in parts.
    """
    schema = f"{MODEL} string, _s long, bloque int, i array<int>, h array<double>, p array<double>"
    rows = texts.select(MODEL, "_s", "w_ham", "w_spam", "i", "cnt", "norma")
    return write_stage(rows.mapInArrow(_added_by_stretch(BLOCK), schema), "taught_gains")


def gains(added: DataFrame, vocab: DataFrame) -> DataFrame:
    """(modelo, term, w_ham, w_spam): what all stretches of ``stretch_gains`` add to the counts."""
    flat = added.select(MODEL, F.inline(F.arrays_zip("i", "h", "p")))
    sums = flat.groupBy(MODEL, "i").agg(F.sum("h").alias("h"), F.sum("p").alias("p"))
    return sums.join(vocab.select(MODEL, "i", "term", "idf"), [MODEL, "i"]).select(
        MODEL, "term", (F.col("h") * F.col("idf")).alias("w_ham"), (F.col("p") * F.col("idf")).alias("w_spam"))


def posterior_after_each(events: DataFrame, vocab: DataFrame, cells: DataFrame, before: NaiveBayes, stretch: int = EVENTS,
                         known: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """(modelo, id, p_posterior) of every event right after the model was taught with it.

    ``events`` are ``weighted_events``, ``vocab`` and ``cells`` the tables of ``text_cells``; ``before`` is
    the model before the first of the events.  ``known`` has the ``stretch_texts`` and ``stretch_gains`` of the same stretch, if
    they are written already.
    """
    if known is None:
        texts = stretch_texts(events, cells, stretch)
        known = texts, stretch_gains(texts)
    texts, added = (df.filter(F.col("_s").isNotNull()) for df in known)
    kinds = events.filter(F.col(ID).isNotNull()).withColumn("_s", F.floor(F.col(ID) / stretch))
    stretches = kinds.groupBy(MODEL, "_s").agg(*[
        F.sum(F.when(F.col("Label_Code") == c, v).otherwise(0.0)).alias(f"_{n}_{k}") for c, k in enumerate(("ham", "spam"))
        for n, v in (("mass", F.col("masa")), ("mails", F.lit(1.0)))])      # one row per model and stretch
    earlier = Window.partitionBy(MODEL).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)

    def so_far(column: str) -> Column:
        return F.coalesce(F.sum(column).over(earlier), F.lit(0.0))

    whole = vocab.groupBy(MODEL).agg(
        F.count(F.lit(1)).alias("_v"), F.sum("w_ham").alias("_ham"), F.sum("w_spam").alias("_spam"))
    start = stretches.select(MODEL, "_s", *[so_far(f"_{n}_{k}").alias(f"_{n}_{k}")
                                            for n in ("mass", "mails") for k in ("ham", "spam")])
    start = start.join(whole, MODEL).join(before.priors, MODEL).select(MODEL, "_s", F.array(
        F.col("n_ham") + F.col("_mails_ham"), F.col("n_spam") + F.col("_mails_spam"),
        F.col("_ham") + F.col("_mass_ham") + before.alpha * F.col("_v"),
        F.col("_spam") + F.col("_mass_spam") + before.alpha * F.col("_v")).alias("h"))

    # The counts of every term at the start of every stretch, a block of terms at a time.
    block = F.floor(F.col("i") / BLOCK).cast("int")
    counts = vocab.withColumn("bloque", block).groupBy(MODEL, "bloque").cogroup(added.groupBy(MODEL, "bloque")).applyInArrow(
        _counts_at_starts(BLOCK), f"{MODEL} string, _s long, bloque int, idf array<double>, h array<double>, p array<double>")

    def null(kind: str, name: str) -> Column:
        return F.lit(None).cast(kind).alias(name)

    lists = [null("array<double>", c) for c in ("idf", "h", "p")]
    text = [null("binary", "clave"), null("binary", "i"), null("binary", "cnt"), null("double", "norma")]
    rows = texts.select(MODEL, "_s", F.lit(0).alias("tipo"), "clave", "i", "cnt", "norma", null("int", "bloque"), *lists)
    rows = rows.unionByName(counts.select(MODEL, "_s", F.lit(1).alias("tipo"), *text, "bloque", "idf", "h", "p"))
    rows = rows.unionByName(start.select(MODEL, "_s", F.lit(2).alias("tipo"), *text, null("int", "bloque"), lists[0], "h", lists[2]))
    # Names of their own: both sides come from the same table.
    kinds = kinds.toDF(*[f"e_{c.lstrip('_')}" for c in kinds.columns])
    return kinds.groupBy(f"e_{MODEL}", "e_s").cogroup(rows.groupBy(MODEL, "_s")).applyInArrow(
        _taught_in_order(before.alpha, BLOCK), f"{MODEL} string, {ID} long, p_posterior double")


# What follows runs inside tasks and is pickled by value, so that workers need no copy of the package.
def _added_by_stretch(block: int):
    """Batches of the rows of ``stretch_texts`` -> the rows of ``stretch_gains``; a task holds the sums of a few stretches."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        names, sums = ["modelo", "_s", "bloque", "i", "h", "p"], {}

        def parts():
            for (model, s), total in sums.items():
                hit = np.flatnonzero(total[-1])      # terms of unlabelled events gain nothing and are asked for as well
                cut = np.flatnonzero(np.append(True, np.diff(hit // block) > 0)) if len(hit) else np.zeros(0, int)
                ends = pa.array(np.append(cut, len(hit)).astype("i4"))
                lists = [pa.ListArray.from_arrays(ends, pa.array(v)) for v in (hit.astype("i4"), *total[:-1, hit])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([model] * len(cut), pa.string()), pa.array([s] * len(cut), pa.int64()),
                     pa.array((hit[cut] // block).astype("i4")), *lists], names)

        for b in batches:
            models, stretches = b.column("modelo").to_pylist(), b.column("_s").to_pylist()
            i, cnt = b.column("i").to_pylist(), b.column("cnt").to_pylist()
            weights = [b.column(c).to_numpy() / b.column("norma").to_numpy() for c in ("w_ham", "w_spam")]
            groups = {}
            for row, key in enumerate(zip(models, stretches)):
                groups.setdefault(key, []).append(row)
            for key, rows in groups.items():
                terms = np.frombuffer(b"".join([i[r] for r in rows]), "<i4")
                tf = 1.0 + np.log(np.frombuffer(b"".join([cnt[r] for r in rows]), "<i4"))
                sizes, old = [len(i[r]) // 4 for r in rows], sums.get(key, np.zeros((3, 0)))
                wide = max(old.shape[1], int(terms.max(initial=-1)) + 1)
                new = np.stack([np.bincount(terms, tf * np.repeat(w[rows], sizes), wide) for w in weights] + [np.bincount(terms, minlength=wide)])
                new[:, :old.shape[1]] += old
                sums[key] = new
                if len(sums) > 64:
                    yield from parts()
                    sums.clear()
        yield from parts()

    return run


def _counts_at_starts(block: int):
    """(terms of a block, gains by stretch) -> the counts of the block at the start of every stretch that has gains."""

    def run(vocab, added):
        import numpy as np
        import pyarrow as pa

        out = pa.schema([("modelo", pa.string()), ("_s", pa.int64()), ("bloque", pa.int32()),
                         *[(c, pa.list_(pa.float64())) for c in ("idf", "h", "p")]])
        if not vocab.num_rows or not added.num_rows:
            return out.empty_table()
        vocab, added = vocab.sort_by("i"), added.sort_by("_s")
        model, which = vocab.column("modelo")[0].as_py(), vocab.column("bloque")[0].as_py()
        idf, *now = (vocab.column(c).to_numpy() for c in ("idf", "w_ham", "w_spam"))
        size, place = len(idf), vocab.column("i").to_numpy() - which * block
        now, rows = np.stack(now), {"_s": [], "h": [], "p": []}
        back = np.zeros(block, np.int64)
        back[place] = np.arange(size)
        lists = {c: added.column(c).combine_chunks() for c in ("i", "h", "p")}
        lists = {c: v.chunk(0) if isinstance(v, pa.ChunkedArray) else v for c, v in lists.items()}
        ends, flat = lists["i"].offsets.to_numpy(), {c: v.values.to_numpy(zero_copy_only=False) for c, v in lists.items()}
        for row, s in enumerate(added.column("_s").to_pylist()):
            if not rows["_s"] or rows["_s"][-1] != s:
                rows["_s"].append(s)
                rows["h"].append(now[0].copy())
                rows["p"].append(now[1].copy())
            a, z = ends[row], ends[row + 1]
            at = back[flat["i"][a:z] - which * block]
            for k, c in enumerate(("h", "p")):
                now[k, at] += flat[c][a:z] * idf[at]
        n = len(rows["_s"])
        bounds = pa.array(np.arange(0, n * size + 1, size, dtype="i4"))
        values = [np.tile(idf, n), *[np.concatenate(rows[c]) for c in ("h", "p")]]
        return pa.table([pa.array([model] * n, pa.string()), pa.array(rows["_s"], pa.int64()), pa.array([which] * n, pa.int32()),
                         *[pa.ListArray.from_arrays(bounds, pa.array(v)) for v in values]], schema=out)

    return run


def _taught_in_order(alpha: float, block: int):
    """What teaches the events of a stretch one after the other."""

    def run(events, known):
        import math

        import numpy as np
        import pyarrow as pa

        out = pa.schema([("modelo", pa.string()), ("message_id", pa.int64()), ("p_posterior", pa.float64())])
        kind = known.column("tipo").to_numpy()
        if not (kind == 2).any() or events.num_rows == 0:
            return out.empty_table()
        n_ham, n_spam, m_ham, m_spam = known.column("h")[int(np.flatnonzero(kind == 2)[0])].as_py()
        blocks = known.filter(pa.array(kind == 1)).sort_by("bloque")
        texts = known.filter(pa.array(kind == 0))
        idf, ham, spam = (np.concatenate([np.zeros(0), *[c.flatten().to_numpy(zero_copy_only=False) for c in blocks.column(name).chunks]])
                          for name in ("idf", "h", "p"))
        # The blocks before and between those of this stretch have no term that its texts know.
        sizes = np.array([len(v) for v in blocks.column("h")], int)
        shift = np.zeros(max([-1, *blocks.column("bloque").to_pylist()]) + 1, np.int64)
        shift[blocks.column("bloque").to_numpy().astype(int)] = np.cumsum(sizes) - sizes
        ham, spam = ham + alpha, spam + alpha
        place = {key: row for row, key in enumerate(texts.column("clave").to_pylist())}
        i, cnt = texts.column("i").to_pylist(), texts.column("cnt").to_pylist()
        ends = np.append(0, np.cumsum([len(v) // 4 for v in i])).astype(int)
        number = np.frombuffer(b"".join(i), "<i4").astype(np.int64)
        terms = shift[number // block] + number % block
        x = (1.0 + np.log(np.frombuffer(b"".join(cnt), "<i4"))) * idf[terms] / np.repeat(texts.column("norma").to_numpy(), np.diff(ends))
        events = events.sort_by("e_message_id")
        seq, keys = events.column("e_message_id").to_numpy(), events.column("e_clave").to_pylist()
        label = events.column("e_Label_Code").to_pylist()
        peso, masa = events.column("e_peso").to_numpy(), events.column("e_masa").to_numpy()
        p, k = [], 0
        while k < len(seq):
            end = k + 1
            while end < len(seq) and seq[end] == seq[k]:
                end += 1
            dot = 0.0
            for j in range(k, end):
                row = place.get(keys[j])
                if row is None:
                    continue
                own, gain = terms[ends[row]:ends[row + 1]], x[ends[row]:ends[row + 1]] * peso[j]
                if label[j] in (0, 1):
                    (spam if label[j] else ham)[own] += gain
                dot += float(gain @ np.log(spam[own] / ham[own]))
            for j in range(k, end):
                if label[j] == 1:
                    n_spam, m_spam = n_spam + 1, m_spam + masa[j]
                elif label[j] == 0:
                    n_ham, m_ham = n_ham + 1, m_ham + masa[j]
                if n_spam <= 0:
                    p.append(None)
                    continue
                margin = math.log(n_spam / n_ham) + dot + masa[j] * (math.log(m_ham) - math.log(m_spam))
                p.append(1.0 / (1.0 + math.exp(-margin)) if margin > -700 else 0.0)
            k = end
        return pa.table([events.column("e_modelo"), events.column("e_message_id"), pa.array(p, pa.float64())], schema=out)

    return run
