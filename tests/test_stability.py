"""Same results on any layout; strict inputs; rows are never multiplied."""

import pytest
from pyspark.sql import functions as F

from colloquy.operators import explain, history, metrics, models, scoring, words
from colloquy.operators.analysis import classify_and_explain
from colloquy.operators.features import text_features
from colloquy.sources import files
from colloquy.sources.fixtures import RuleModel
from colloquy.streaming import accepted, decode_messages, rejects


@pytest.fixture(scope="module")
def labelled(spark):
    text = [f"alpha beta w{k} gift card now" if k % 3 == 0 else f"hello meeting w{k} tuesday" for k in range(90)]
    rows = [(k, t, t, float(k % 3 == 0)) for k, t in enumerate(text)]
    return spark.createDataFrame(rows, "doc_id long, dialogue string, clean_text string, labels double")


def test_vocabulary_and_forest_do_not_depend_on_the_layout(labelled):
    seen = []
    for n in (1, 7):
        prep = models.prepare_training(labelled.repartition(n), vocab_size=20, key="doc_id", partitions=3 * n)
        model = prep.fit(models.RANDOM_FOREST, numTrees=8)
        prep.release()
        rows = scoring.score(model, labelled.select("doc_id", "dialogue")).select("doc_id", "prediction", "confidence")
        seen.append((words.feature_terms(model), sorted(map(tuple, rows.collect()))))
    assert seen[0] == seen[1]
    assert len(seen[0][0]) == 20


def test_score_all_equals_score_by_score(labelled):
    fitted = models.fit_models(labelled, (models.DECISION_TREE, models.LOGISTIC_REGRESSION), vocab_size=50, key="doc_id")
    got = sorted(map(tuple, scoring.score_all(fitted, labelled, ["doc_id"]).collect()))
    want = []
    for name, model in fitted.items():
        rows = scoring.score(model, labelled.select("doc_id", "dialogue")).select("doc_id", "prediction", "confidence")
        want += [(name, *r) for r in rows.collect()]
    assert got == sorted(want)


def test_decode_is_strict(spark):
    cases = [('{"text":"a"}', None), (' {"text":"a", "x":[1,{}]}\n', None), ('{"text":"a"} garbage', "bad_json"),
             ('{"text":"a"}{"text":"b"}', "bad_json"), ('{"text":5}', "no_text"), ('{"text":{"a":1}}', "no_text"),
             ('{"text":null}', "no_text"), ('{}', "no_text"), ("", "bad_json"), (None, "bad_json"), ("[]", "bad_json"),
             ('"text"', "bad_json"), ('{"text":"a"},"x":1', "bad_json"), ('{"text":"a"},"end":true', "bad_json"),
             ('{"text":"a"', "bad_json"), ('{"text":""}', None), ('{"text":"é\\u0041"}', None)]
    df = spark.createDataFrame([(k, v) for k, (v, _) in enumerate(cases)], "key long, value string")
    got = {r.key: (r.text, r.reject_reason) for r in decode_messages(df).collect()}
    assert [got[k][1] for k in range(len(cases))] == [reason for _, reason in cases]
    assert got[0][0] == "a" and got[15][0] == "" and got[16][0] == "éA"
    assert all(got[k][0] is None for k, (_, reason) in enumerate(cases) if reason)
    assert accepted(decode_messages(df)).count() + rejects(decode_messages(df)).count() == len(cases)


def test_repeated_keys_keep_their_row_count(spark):
    df = spark.createDataFrame([(1, "hello there"), (1, "hello there"), (2, "bye")], "conv_id long, dialogue string")
    out = classify_and_explain(RuleModel(), df, "conv_id")
    assert out.count() == 3
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_labelled_csv_by_header_name(spark, tmp_path):
    p = tmp_path / "reordered.csv"
    p.write_text('labels,extra,dialogue,type,personality\n1,x,"hello, ""you""",t,p\n0,y,bye,t,p\n1,only three\n')
    rows = files.read_labelled(spark, str(p), malformed="bad").collect()
    assert [(r.dialogue, r.labels, r.type) for r in rows[:2]] == [('hello, "you"', "1", "t"), ("bye", "0", "t")]
    assert [r.bad is not None for r in rows] == [False, False, True]
    q = tmp_path / "short.csv"
    q.write_text("labels,text\n1,a\n")
    with pytest.raises(files.MissingColumnError):
        files.read_labelled(spark, str(q))


def test_confusion_keeps_every_prediction(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0), (0.0, 0.5), (0.0, None), (0.0, 0.0)], "labels double, prediction double")
    rows = {r.labels_prediction: r for r in metrics.confusion_matrix(df).collect()}
    assert (rows["1.0"].predicted_1, rows["1.0"].predicted_other) == (1, 1)
    assert (rows["0.0"].predicted_0, rows["0.0"].predicted_other) == (1, 2)


def test_similarity_is_the_same_for_any_chunks(spark, monkeypatch):
    texts = [f"common alpha word{k % 5} term{k}" if k % 3 else "exact copy of one text" for k in range(60)]
    hist = text_features(spark.createDataFrame(list(enumerate(texts)), "hid long, dialogue string"))
    qry = text_features(spark.createDataFrame([(k, texts[k]) for k in range(0, 60, 7)], "qid long, dialogue string"))
    seen = []
    for chunk, terms, parts in ((2500, 10**6, 1), (7, 20, 4), (1, 5, 9)):
        monkeypatch.setattr(history, "CHUNK_DOCS", chunk)
        monkeypatch.setattr(history, "QUERY_TERMS", terms)
        rows = history.similar_cases_for(qry.repartition(parts), "qid", hist.repartition(parts), "hid", k=4)
        seen.append(sorted(map(tuple, rows.collect())))
    assert seen[0] == seen[1] == seen[2]


def test_history_prompt_reads_the_history_in_place(spark):
    hist = spark.createDataFrame([(1, "a b"), (2, "c d")], "hid long, text string")
    sim = spark.createDataFrame([(7, 1, 2, 0.5)], "qid long, rank long, hid long, similarity double")
    cases = spark.createDataFrame([(7, "new")], "qid long, dialogue string")
    out = explain.history_prompts(cases, "qid", sim, hist, "hid")
    assert "c d" in out.first().prompt
    whole = explain.history_prompts(cases, "qid", sim, hist.withColumn("label", F.lit(None).cast("int")), "hid",
                                    fields=("hid", "label"))
    assert "hid=2, label=null; c d" in whole.first().prompt
    assert out.agg(F.count(F.lit(1))).first()[0] == 1


def test_kafka_credentials_are_escaped():
    from colloquy.sources.kafka import kafka_reader_options
    o = kafka_reader_options({"KAFKA_SECURITY_PROTOCOL": "SASL_SSL", "KAFKA_USERNAME": 'a"b', "KAFKA_PASSWORD": "c\\d"})
    assert 'username="a\\"b" password="c\\\\d";' in o["kafka.sasl.jaas.config"]
