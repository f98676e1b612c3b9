"""Every registered exact query equals its DuckDB oracle at sf0.01; the
entry point and rows-only queries run."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from scripts.check_oracle import TABLES, rows_of

from conftest import SF01

EXACT = sorted(n for n in E.oracle_sql() if n != "pipeline" and not n.startswith("op"))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF01}/{t}.parquet"
        if os.path.exists(p):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_registry_consistent():
    qs = E.queries()
    assert set(E.oracle_sql()) <= set(qs)
    own = [n for n in qs if n != "pipeline" and not n.startswith("op")]
    assert len(own) == 69
    assert set(own) <= set(E.oracle_sql())      # every query of the library proper has its SQL


@pytest.mark.parametrize("name", EXACT)
def test_oracle(spark, con, name):
    sp = E.queries()[name](spark, SF01).toPandas()
    dd = con.sql(E.oracle_sql()[name]).df()
    c1, k1, r1 = rows_of(sp)
    c2, k2, r2 = rows_of(dd)
    assert c1 == c2
    assert k1 == k2
    assert len(r1) == len(r2)
    assert r1 == r2


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["word", "scam_count", "non_scam_count", "scam_ratio"]
    assert df.count() == 20


def test_oracle_detects_mutation(spark, con):
    """A deliberately wrong tokeniser (plain split keeps trailing empties)
    must not pass the tokens oracle."""
    from pyspark.sql import functions as F

    from colloquy.functions.text import clean_text
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    words = F.split(clean_text("text"), " ")
    bad = docs.select("doc_id", F.to_json(words).alias("words_json"), F.size(words).cast("bigint").alias("n_words"))
    _, _, r1 = rows_of(bad.toPandas())
    _, _, r2 = rows_of(con.sql(E.oracle_sql()["tokens_f01"]).df())
    assert len(r1) == len(r2) and r1 != r2
