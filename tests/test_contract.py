import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, compare

SMALL = "/root/testdata/sf0.001"
CHECKED = ["clean_corpus", "cleaning_funnel", "meta_tokens", "lexical_translate", "segment_sentences",
           "stratified_split", "language_detect", "nb_score", "top_terms", "history_timeline", "length_density"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return c


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, SMALL).startswith("ok")


def test_entry(spark):
    assert entry.entry(spark).count() == 1


IMPORT_ALONE = """
import sys
from importlib.abc import MetaPathFinder


class Missing(MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name in {hidden!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)


sys.meta_path.insert(0, Missing())
import __spark_entry__ as entry
from pyspark import SparkContext
assert SparkContext._active_spark_context is None
assert len(entry.queries()) > 100 and set(entry.oracle_sql()) <= set(entry.queries())
print("pipeline" in entry.queries())
"""


@pytest.mark.parametrize("hidden", [(), ("cartero.llm", "corpus_pipeline")])
def test_import_needs_no_session_and_no_optional_part(hidden):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", IMPORT_ALONE.format(hidden=hidden)], cwd=root, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    has_part = os.path.isdir(os.path.join(root, "cartero", "llm")) and not hidden
    assert done.stdout.split()[-1] == str(has_part)


def test_shuffle_is_a_permutation(spark):
    ranks = sorted(r.posicion for r in entry.queries()["shuffle"](spark, SMALL).collect())
    assert ranks == list(range(1, len(ranks) + 1))


def test_catalogue_stream_equals_batch(spark):
    batch, stream = (sorted(map(str, entry.queries()[n](spark, SMALL).collect())) for n in ("retrain_catalog", "retrain_catalog_stream"))
    assert batch == stream
