"""Property tests: random strings / numbers, checked in one Spark job each."""

import re
from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import Tokenizer
from pyspark.sql import functions as F

from colloquy.functions.formats import round_ratio
from colloquy.functions.text import clean_text, has_clean_text, tokenize

ALPHABET = st.sampled_from(list("ab Z\t\n\r\x0b\x0c.,'!09éİKß€ ") + ["  ", " "])
TEXTS = st.lists(st.lists(ALPHABET, max_size=12).map("".join), min_size=1, max_size=60)
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _py_clean(t):
    return re.sub(r"[^a-zA-Z ]", "", t.lower())


@SETTINGS
@given(texts=TEXTS)
def test_tokenize_matches_mllib(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    df = Tokenizer(inputCol="t", outputCol="ml").transform(df.withColumn("c", clean_text("t")))
    df = Tokenizer(inputCol="c", outputCol="ml_c").transform(df)
    out = df.select("id", "t", "c", "ml", "ml_c", tokenize("t").alias("ours"),
                    tokenize("c", clean_input=True).alias("ours_c"), has_clean_text("t").alias("nonempty")).collect()
    for r in out:
        assert list(r["ours"]) == list(r["ml"]), repr(r["t"])
        assert list(r["ours_c"]) == list(r["ml_c"]), repr(r["t"])
        assert r["nonempty"] == (r["c"] != ""), repr(r["t"])


@SETTINGS
@given(pairs=st.lists(st.tuples(st.integers(0, 10 ** 6), st.integers(0, 10 ** 6)), min_size=1, max_size=50))
def test_round_ratio_is_half_up_on_the_fraction(spark, pairs):
    rows = [(a, a + b) for a, b in pairs]
    df = spark.createDataFrame(rows, "a long, b long")
    got = [r[0] for r in df.select(round_ratio("a", "b", 3)).collect()]
    for (a, b), g in zip(rows, got):
        want = 0.0 if b == 0 else float((Fraction(2000 * a + b, 2 * b)).__floor__()) / 1000
        assert g == want, (a, b)


def _pairwise_auc(rows):
    pos = [s for y, s in rows if y > 0.5]
    neg = [s for y, s in rows if y <= 0.5]
    if not pos or not neg:
        return None
    win = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return win / (len(pos) * len(neg))


def _weighted_f1(rows):
    labels = sorted({y for y, _ in rows})
    total, acc = len(rows), 0.0
    for c in labels:
        tp = sum(1 for y, p in rows if y == c and p == c)
        pred = sum(1 for _, p in rows if p == c)
        sup = sum(1 for y, _ in rows if y == c)
        prec = tp / pred if pred else 0.0
        rec = tp / sup
        acc += sup * (0.0 if prec + rec == 0 else 2 * prec * rec / (prec + rec))
    return acc / total


@SETTINGS
@given(data=st.lists(st.tuples(st.integers(0, 2), st.booleans(), st.integers(0, 6), st.booleans()),
                     min_size=1, max_size=80),
       buckets=st.integers(1, 9))
def test_auc_and_f1_match_brute_force(spark, data, buckets):
    from colloquy.operators import metrics
    rows = [(g, 1.0 if y else 0.0, float(s) / 3, 1.0 if p else 0.0) for g, y, s, p in data]
    df = spark.createDataFrame(rows, "g int, labels double, score double, prediction double")
    got_auc = {r["g"]: r["auc"] for r in metrics.roc_auc(df, ["g"], buckets=buckets).collect()}
    got_f1 = {r["g"]: r["f1"] for r in metrics.classification_metrics(df, ["g"]).collect()}
    for g in {r[0] for r in rows}:
        part = [r for r in rows if r[0] == g]
        want = _pairwise_auc([(y, s) for _, y, s, _ in part])
        assert (got_auc[g] is None and want is None) or abs(got_auc[g] - want) < 1e-12, (g, got_auc[g], want)
        assert abs(got_f1[g] - _weighted_f1([(y, p) for _, y, _, p in part])) < 1e-12
