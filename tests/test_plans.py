"""Plan regressions: the physical-plan properties PLANS.md relies on."""

from pyspark.sql import functions as F

from colloquy.operators import cleaning, features, words
from colloquy.sources.tables import labelled_documents, read_table

from conftest import SF01


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _final(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _docs(spark):
    return features.text_features(read_table(spark, SF01, "documents").select("doc_id", F.col("text").alias("dialogue")))


def test_no_inferred_size_filter_before_explode(spark):
    plan = _optimized(features.term_frequency(_docs(spark), "doc_id"))
    assert "size(" not in plan, "an inferred size(words) > 0 filter re-runs tokenising in the scan"
    assert "INSET" in plan  # stop words as a hash-set row predicate


def test_empty_text_filter_does_not_reclean_in_scan(spark):
    df = cleaning.drop_empty(cleaning.with_clean_text(labelled_documents(spark, SF01)), source="dialogue")
    filters = [ln for ln in _optimized(df).splitlines() if "Filter" in ln]
    assert any("RLIKE" in ln for ln in filters)
    assert not any("regexp_replace" in ln for ln in filters)


def test_tfidf_tokenises_once(spark):
    plan = _final(features.tfidf_table(_docs(spark), "doc_id"))
    assert "ReusedExchange" in plan and "count" in plan.split("ReusedExchange", 1)[1].splitlines()[0]


def test_small_term_list_is_broadcast(spark):
    docs = _docs(spark).withColumn("labels", F.lit(1.0))
    terms = spark.createDataFrame([("alpha",), ("beta",)], "word string")
    plan = _final(words.word_class_counts(docs, terms))
    assert "BroadcastHashJoin" in plan


def test_no_cross_joins_in_registered_queries(spark):
    import __spark_entry__ as E
    qs = E.queries()
    offenders = []
    for name in sorted(E.oracle_sql()):
        plan = qs[name](spark, SF01)._jdf.queryExecution().executedPlan().toString()
        if "CartesianProduct" in plan or "BroadcastNestedLoopJoin" in plan:
            offenders.append(name)
    assert offenders == []


def test_similarity_plan_has_no_pair_join(spark):
    import __spark_entry__ as E
    df = E.queries()["similar_h02"](spark, SF01)
    # exactly two joins, both "tf x idf" weightings (history and queries); a
    # query-document pair join on term would be a third
    joins = [ln for ln in _optimized(df).splitlines() if "Join " in ln]
    assert len(joins) == 2 and all("idf" in ln and "term" in ln for ln in joins)
    plan = _final(df)
    assert "FlatMapCoGroupsInPandas" in plan and "WindowGroupLimit" in plan


def test_vocabulary_cut_uses_threshold(spark):
    plan = _optimized(features.vocabulary(_docs(spark), size=100))
    assert "scalar-subquery" in plan.lower() or "subquery" in plan.lower()
