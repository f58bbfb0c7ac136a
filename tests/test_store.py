"""Stored translations, the failure channel and resumption."""

import pytest
from pyspark.sql import functions as F

from cartero.operators import store, translate


def loud():
    """A translator that fails on a word, as a whole batch; a closure, so that tasks need not import this module."""
    def shout(texts):
        if any("boom" in t for t in texts):
            raise RuntimeError("no memory")
        return [None if t == "mute" else t.upper() for t in texts]
    return shout


shout = loud()


def safely(rows):
    return translate.translate_fragments_safely(rows, shout, "text")


@pytest.fixture()
def mails(spark):
    rows = [(i, f"Line {i // 2}.") for i in range(40)] + [(40, "boom one."), (41, "mute"), (42, None), (43, "")]
    return spark.createDataFrame(rows, "message_id long, text string")


def test_a_failing_batch_loses_only_its_failing_texts():
    texts = [f"t{i}" for i in range(100)] + ["boom"] + ["a"] * 30 + ["boom too", "mute"]
    out = translate.bisected(shout, texts)
    assert [t for t, _ in out] == [None if "boom" in t or t == "mute" else t.upper() for t in texts]
    assert {e for t, e in out if t is None} == {"RuntimeError: no memory", "no translation"}
    assert translate.bisected(shout, []) == [] and translate.bisected(lambda t: [], ["a"])[0][1].startswith("ValueError")


def test_failures_are_counted_by_mail(spark):
    long = "Fine words here. " * 40 + "boom now. " + "More fine words. " * 40
    df = spark.createDataFrame([(1, long), (2, "Fine."), (3, "")], "message_id long, text string")
    got = {r.message_id: r for r in safely(df).collect()}
    assert (got[1].texto_es, got[1].fallos, got[1].error) == (None, 1, "RuntimeError: no memory") and got[1].num_fragmentos > 2
    assert got[2].texto_es == "FINE." and (got[2].fallos, got[2].error) == (0, None) and got[3].fallos == 0
    kept = translate.safe_translate(df.join(safely(df).withColumnRenamed("texto_es", "traducido"), "message_id"), text="text")
    assert {r.message_id: r.fallo for r in kept.collect()} == {1: True, 2: False, 3: False}


def test_second_run_translates_nothing(spark, mails, tmp_path):
    kept = store.TranslationStore(str(tmp_path / "s"))
    assert kept.entries(spark).count() == 0
    assert kept.fill(mails, safely, chunks=3) == store.Filled(23, 0, 23, 2)

    def never(rows):
        raise AssertionError("asked again")

    assert kept.fill(mails, never, chunks=3) == store.Filled(23, 23, 0, 0)
    assert kept.fill(mails, lambda rows: rows.select("message_id", F.upper("text").alias("texto_es"), F.lit(1).alias("num_fragmentos")),
                     chunks=3, retry=True) == store.Filled(23, 21, 2, 0)
    got = {r.message_id: r for r in kept.apply(mails).collect()}
    assert len(got) == 44 and got[0].texto_es == got[1].texto_es == "LINE 0." and got[40].texto_es == "BOOM ONE."
    assert not any(r.fallo for r in got.values()) and got[42].texto_es is None and got[42].num_fragmentos == 0
    assert store.TranslationStore(kept.path, "2").entries(spark).count() == 0


def test_failed_and_unknown_texts_stay_as_they_are(spark, mails, tmp_path):
    kept = store.TranslationStore(str(tmp_path / "s"))
    kept.fill(mails.filter("message_id <> 0 AND message_id <> 1"), safely, chunks=2)
    got = {r.message_id: (r.texto_es, r.fallo) for r in kept.apply(mails).collect()}
    assert got[0] == ("Line 0.", True) and got[40] == ("boom one.", True) and got[41] == ("mute", True)
    assert got[2] == ("LINE 1.", False) and got[42] == (None, False)


def test_a_run_that_dies_between_chunks_is_resumed(spark, mails, tmp_path):
    kept, calls = store.TranslationStore(str(tmp_path / "s")), []

    def dies(rows):
        calls.append(1)
        if len(calls) == 3:
            raise KeyboardInterrupt
        return safely(rows)

    with pytest.raises(KeyboardInterrupt):
        kept.fill(mails, dies, chunks=4)
    before = kept.entries(spark).count()
    assert 0 < before < 23
    # Entries without a manifest, as a writer leaves them that dies while it commits, do not count.
    spark.createDataFrame([(bytearray(b"x"), "half", 1, None, "half")], store.ENTRY).write.parquet(f"{kept.path}/v=1/data/half")
    done = kept.fill(mails, safely, chunks=4)
    assert (done.textos, done.reutilizados, done.traducidos) == (23, before, 23 - before)
    rows = spark.read.schema(store.ENTRY).parquet(*[f"{kept.path}/v=1/data/{n}" for n in kept.chunks(spark)])
    assert rows.count() == rows.select("clave").distinct().count() == 23
