"""Feed as running state, topic without doubles, controlled stop."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from colloquy.sources.fixtures import RuleModel
from colloquy.streaming import Control, ScoringStream, advance_feed, file_topic, latest_feed, once, outgoing, read_feed

ROWS = "key string, text string, prediction double, confidence double, partition int, offset long"


def _scored(spark, ids, **same):
    return spark.createDataFrame([(f"k{i}", f"text {i}", float(i % 2), 0.5 + i / 1000, i % 3, same.get("offset", i)) for i in ids], ROWS)


def _messages(spark, path, n=24, files=8):
    rows = [(f"k{i}", '{"text":"hello number %d"}' % i if i % 5 else "{oops", i % 3, i) for i in range(n)]
    df = spark.createDataFrame(rows, "key string, value string, partition int, offset long")
    df.repartition(files).write.parquet(path)
    return df.schema, {f"k{i}" for i in range(n) if i % 5}


def _stream(spark, base, schema, **kw):
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(base + "/in")
    return ScoringStream(RuleModel(), source, base + "/results", base + "/rejects", base + "/checkpoint", **kw)


def test_feed_after_each_step_equals_the_whole(spark):
    seen, state = [], None
    for ids in ([3, 9, 4], [], [1, 2], [11, 10, 12, 13, 14, 15]):
        seen += ids
        step = advance_feed(state, _scored(spark, ids), 5)
        state = spark.createDataFrame(step.collect(), step.schema)
        whole = _scored(spark, seen).orderBy(F.desc("offset")).limit(5)
        assert sorted(r.key for r in state.collect()) == sorted(r.key for r in whole.collect())
        assert {r.processed for r in state.collect()} == {len(seen)}


def test_feeds_apart_ties_and_empty(spark):
    feed = F.when(F.col("partition") < 2, F.col("partition"))
    out = advance_feed(None, _scored(spark, range(30)), 2, feed)
    got = {}
    for r in out.collect():
        got.setdefault(r.feed, []).append((r.offset, r.processed))
    assert {k: sorted(v) for k, v in got.items()} == {
        "0": [(24, 10), (27, 10)], "1": [(25, 10), (28, 10)], None: [(26, 10), (29, 10)]}
    again = advance_feed(out, _scored(spark, [32]), 2, feed).filter("feed IS NULL").collect()
    assert sorted((r.offset, r.processed) for r in again) == [(29, 11), (32, 11)]
    tied = advance_feed(None, _scored(spark, range(9), offset=7), 3).collect()
    assert sorted(r.key for r in tied) == ["k2", "k5", "k8"]          # highest partition, then key
    assert advance_feed(None, _scored(spark, []), 3).count() == 0


def test_tasks_pass_on_the_latest_rows_only(spark):
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    first = advance_feed(None, _scored(spark, range(9)), 3)
    assert "TakeOrderedAndProject" in plan(first)                     # one feed
    assert "WindowGroupLimit" in plan(advance_feed(first, _scored(spark, range(9)), 3))
    assert "WindowGroupLimit" in plan(advance_feed(None, _scored(spark, range(9)), 3, F.col("partition")))


def test_topic_read_once(spark):
    sent = outgoing(_scored(spark, range(6)), 4).withColumn("timestamp", F.current_timestamp())
    bare = sent.filter("key = 'k1'").withColumn("headers", F.lit(None).cast(sent.schema["headers"].dataType))
    other = sent.filter("key = 'k2'").withColumn("headers", F.filter("headers", lambda h: h["key"] == "batch"))
    got = once(sent.unionByName(sent).unionByName(bare).unionByName(bare).unionByName(other)).collect()
    assert sorted(r.source for r in got if r.source) == ["0:0", "0:3", "1:1", "1:4", "2:2", "2:5"]
    assert len([r for r in got if r.source is None]) == 3            # cannot be told apart: all stay


def test_repeated_batch_feed_and_topic(spark, tmp_path):
    base = str(tmp_path)
    schema, keys = _messages(spark, base + "/in")
    send, calls = file_topic(base + "/topic"), []

    def lossy(rows):
        send(rows)
        calls.append(1)
        if len(calls) == 3:
            raise ConnectionError("lost after sending")

    def run():
        _stream(spark, base, schema, topic=lossy, feed_path=base + "/feed").start().await_done()

    with pytest.raises(StreamingQueryException):
        run()
    run()
    assert len(calls) == 5                                            # four batches, one of them twice
    sent = spark.read.parquet(base + "/topic")
    assert sent.count() > len(keys) and {r.key for r in once(sent).collect()} == keys and once(sent).count() == len(keys)
    results = spark.read.parquet(base + "/results")
    shown = read_feed(spark, base + "/feed")
    assert {r.processed for r in shown.collect()} == {len(keys)}
    same = ["offset", "key", "label", "confidence_text", "preview"]
    assert sorted(shown.select(same).collect()) == sorted(latest_feed(results, 5).select(same).collect())
    for batch in range(4):                                            # after every batch, not only the last
        so_far = results.filter(F.col("batch_id") <= batch)
        step = spark.read.parquet(f"{base}/feed/batch_id={batch}")
        assert sorted(r.offset for r in step.collect()) == sorted(r.offset for r in latest_feed(so_far, 5).collect())
        assert {r.processed for r in step.collect()} == {so_far.count()}


def test_controlled_stop(spark, tmp_path):
    base = str(tmp_path)
    schema, keys = _messages(spark, base + "/in")
    control = Control(spark, base + "/control")
    asked = control.request_stop(after_batch=1)
    first = _stream(spark, base, schema, control=control).start()
    assert first.await_done() and not first.running and first.stopped_by == [(asked, 2)]
    assert {r.batch_id for r in spark.read.parquet(base + "/results").select("batch_id").collect()} == {0, 1}
    log = [(r.event, r.batch_id, r.request) for r in control.log().collect()]
    assert ("stopped", 2, asked) in log and sorted(b for e, b, _ in log if e == "batch") == [0, 1]
    second = _stream(spark, base, schema, control=control).start()    # the request is served: it goes on
    assert second.await_done() and second.stopped_by == []
    out = spark.read.parquet(base + "/results")
    assert out.count() == len(keys) and {r.key for r in out.collect()} == keys
    runs = control.log().groupBy("run").agg(F.collect_set("event").alias("e")).collect()
    assert sorted(sorted(r.e) for r in runs) == [["batch", "ended"], ["batch", "stopped"]]


def test_other_failures_are_raised_and_logged(spark, tmp_path):
    base = str(tmp_path)
    schema, _ = _messages(spark, base + "/in", 6, 2)
    control = Control(spark, base + "/control")

    def broken(_rows):
        raise ConnectionError("no topic")

    with pytest.raises(StreamingQueryException):
        _stream(spark, base, schema, control=control, topic=broken).start().await_done()
    assert [r.event for r in control.log().collect()] == ["failed"]


def test_more_messages_make_no_more_batches(spark, tmp_path):
    from colloquy.plans import extra, streams
    turns = spark.range(4_200).select((F.col("id") / 5).cast("long").alias("conv_id"), (F.col("id") % 5).cast("int").alias("turn"),
                                      F.lit("caller").alias("role"), F.concat(F.lit("call me back "), "id").alias("text"))
    turns.coalesce(1).write.parquet(str(tmp_path / "conversations.parquet"))
    due = streams.processed_t05(spark, str(tmp_path)).first().processed
    base = streams.run_stream(spark, str(tmp_path), rule=True)
    got = spark.read.parquet(base + "/results")
    assert got.count() == due == got.select("key", "offset").distinct().count()
    assert got.select("batch_id").distinct().count() == streams.BATCHES
    assert {tuple(r) for r in extra.restart_t04(spark, str(tmp_path)).groupBy("copies").count().collect()} == {(1, due)}
