"""Command line: the reference's programs as Spark jobs.

    python -m colloquy train   --labelled dialogues.csv --model out/model [--models DT,RF,GBT,LR]
    python -m colloquy score   --model out/model --csv uploads.csv --out out/predictions
    python -m colloquy index   --history history.csv --index out/history
    python -m colloquy stream  --model out/model --source-dir in/ --out out/stream [--kafka] [--requests [--index out/history]]
    python -m colloquy explain --model out/model --text "..." [--index out/history | --history history.csv]

Every subcommand builds DataFrame plans from the library; nothing loops over
rows on the driver.  Outputs go to the given folders (CSV / parquet).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

MODEL_NAMES = {"DT": "DecisionTree", "RF": "RandomForest", "GBT": "GradientBoostedTrees",
               "LR": "LogisticRegression"}


def _session(args):
    from colloquy.session import build_session
    return build_session(args.master, app=f"colloquy-{args.cmd}")


def cmd_train(args) -> int:
    """train: split, fit, evaluate, pick and save; print the report."""
    from colloquy.operators import cleaning, features, metrics
    from colloquy.plans.training import run_training, word_report
    from colloquy.sources.files import read_labelled

    spark = _session(args)
    raw = read_labelled(spark, args.labelled)
    labelled = cleaning.load_and_clean(raw).withColumn("row_id", F.xxhash64("dialogue", "personality", "type"))
    names = [MODEL_NAMES[n.strip().upper()] for n in args.models.split(",")]
    run = run_training(labelled.select("row_id", "dialogue", "labels", "clean_text"), key="row_id",
                       names=names, kind=args.features, model_path=args.model, partitions=args.partitions)
    for r in run.split_counts.orderBy("dataset").collect():
        print(f"{r['dataset']}: {r['n']}")
    for r in metrics.report_lines(run.metrics).orderBy("Model", "Dataset", "Metric").collect():
        print(f"{r['Model']} {r['Dataset']} {r['line']}")
    print(f"best model: {run.best_name} (saved to {args.model})")
    words_df = features.with_tokens(labelled.select("labels", "clean_text"))
    reports = word_report(spark, run, words_df, n=args.top_words)
    for name, stats in reports.items():
        print(f"\n{name} - top words")
        stats.show(args.top_words, truncate=False)
    if args.tables:
        _write_tables(args.tables, run, reports)
        print(f"tables written to {args.tables}")
    return 0


def _write_tables(folder: str, run, reports: dict) -> None:
    """The tables behind the reference's figures, as CSV folders: metrics
    (E07), confusion matrices (E06), split counts (X02) and per model the
    word statistics (A04), their long form (A05) and ratio order (A06)."""
    from colloquy.operators import words

    def csv(df, name):
        df.coalesce(1).write.mode("overwrite").option("header", "true").csv(f"{folder.rstrip('/')}/{name}")

    csv(run.metrics, "metrics")
    csv(run.confusion, "confusion")
    csv(run.split_counts, "split_counts")
    for name, stats in reports.items():
        csv(stats, f"word_stats_{name}")
        csv(words.melt_counts(stats), f"word_counts_long_{name}")
        csv(words.rank_by_ratio(stats), f"word_ratio_{name}")


def cmd_score(args) -> int:
    """score: a CSV with a dialogue column -> predictions CSV."""
    from colloquy.operators import models, scoring
    from colloquy.sources.files import read_history, require_columns, write_predictions_csv

    spark = _session(args)
    df = require_columns(read_history(spark, args.csv, infer=False))
    scored = scoring.score(models.load_model(args.model), df.select("dialogue"))
    write_predictions_csv(scoring.classified_batch(scored), args.out)
    print(f"predictions written to {args.out}")
    return 0


def cmd_stream(args) -> int:
    """stream: score messages from files or Kafka until drained (or stopped)."""
    from colloquy.operators import models
    from colloquy.sources.kafka import kafka_writer_options, read_kafka_stream
    from colloquy.streaming import ScoringStream

    spark = _session(args)
    if args.kafka:
        # without a limit the first batch of a continuous run is the entire backlog
        limit = args.max_per_trigger or (10_000 if args.continuous else None)
        source = read_kafka_stream(spark, max_offsets_per_trigger=limit)
        sink = kafka_writer_options()
    else:
        source = (spark.readStream.schema("key string, value string, partition int, offset long")
                  .option("maxFilesPerTrigger", args.max_per_trigger or 1).parquet(args.source_dir))
        sink = None
    out = args.out.rstrip("/")
    index = _history_index(spark, args)
    stream = ScoringStream(models.load_model(args.model), source, out + "/results", out + "/rejects",
                           out + "/checkpoint", kafka_options=sink, encoded_path=out + "/encoded",
                           requests_path=out + "/requests" if args.requests else None,
                           history_index=index)
    stream.start(available_now=not args.continuous, processing_time="1 second" if args.continuous else None)
    try:
        stream.await_done()
    except KeyboardInterrupt:
        stream.stop()
    print(f"processed {stream.processed()} messages, rejected {stream.rejected()}; output in {out}")
    return 0


def _history_index(spark, args):
    """The index named by ``--index``, else one made for this run from the CSV
    named by ``--history`` (its rows keep ids of their own, equal rows too)."""
    from colloquy.operators.history import HistoryIndex
    from colloquy.session import scratch_path
    from colloquy.sources.files import read_history, require_columns
    if args.index:
        index = HistoryIndex(spark, args.index)
        if not index.batches:
            raise SystemExit(f"no history index under {args.index}")
        return index
    if not args.history:
        return None
    index = HistoryIndex(spark, scratch_path(spark, "history-index"))
    return index.append(index.numbered(require_columns(read_history(spark, args.history, infer=False))), "id")


def cmd_index(args) -> int:
    """index: a history CSV into a new index, or appended to an old one."""
    from colloquy.operators.history import HistoryIndex
    from colloquy.sources.files import read_history, require_columns

    spark = _session(args)
    index = HistoryIndex(spark, args.index)
    index.append(index.numbered(require_columns(read_history(spark, args.history, infer=False))), "id").vectors()
    print(f"{index.docs} cases in {index.batches} batches under {args.index}")
    return 0


def cmd_explain(args) -> int:
    """explain: one dialogue -> prediction and explanation requests."""
    from colloquy.operators import analysis, models
    from colloquy.sources.files import single_text

    spark = _session(args)
    model = models.load_model(args.model)
    one = single_text(spark, args.text).withColumn("case_id", F.lit(0).cast("long"))
    row = analysis.classify_and_explain(model, one, "case_id", k=args.k, index=_history_index(spark, args)).first()
    print(f"prediction: {row['prediction']}  confidence: {row['confidence']}")
    print("\n--- analysis request ---\n" + row["prompt"])
    if row["history_prompt"]:
        print("\n--- history request ---\n" + row["history_prompt"])
    return 0


def main(argv=None) -> int:
    """Parse arguments and run a subcommand."""
    p = argparse.ArgumentParser(prog="colloquy")
    p.add_argument("--master", default=None, help="Spark master (default: from the environment)")
    sub = p.add_subparsers(dest="cmd", required=True)

    t = sub.add_parser("train", help="train, evaluate, pick and save the best model")
    t.add_argument("--labelled", required=True)
    t.add_argument("--model", required=True)
    t.add_argument("--models", default="DT,RF,GBT")
    t.add_argument("--features", choices=("count", "hash"), default="count")
    t.add_argument("--partitions", type=int, default=8, help="partitions of the training rows (cores of a large run)")
    t.add_argument("--top-words", type=int, default=10)
    t.add_argument("--tables", help="folder for the metrics / confusion / word tables (CSV)")
    t.set_defaults(fn=cmd_train)

    s = sub.add_parser("score", help="score a CSV with a 'dialogue' column")
    s.add_argument("--model", required=True)
    s.add_argument("--csv", required=True)
    s.add_argument("--out", required=True)
    s.set_defaults(fn=cmd_score)

    st = sub.add_parser("stream", help="score a stream of {'text': ...} messages")
    st.add_argument("--model", required=True)
    st.add_argument("--out", required=True)
    st.add_argument("--source-dir")
    st.add_argument("--kafka", action="store_true")
    st.add_argument("--max-per-trigger", type=int, default=None)
    st.add_argument("--continuous", action="store_true")
    st.add_argument("--requests", action="store_true", help="also write explanation requests per message")
    st.add_argument("--history", help="CSV with a 'dialogue' column for history requests (with --requests)")
    st.add_argument("--index", help="history index in place of --history")
    st.set_defaults(fn=cmd_stream)

    i = sub.add_parser("index", help="make a history index, or append to it")
    i.add_argument("--history", required=True, help="CSV with a 'dialogue' column")
    i.add_argument("--index", required=True)
    i.set_defaults(fn=cmd_index)

    e = sub.add_parser("explain", help="classify one dialogue and build its explanation requests")
    e.add_argument("--model", required=True)
    e.add_argument("--text", required=True)
    e.add_argument("--history")
    e.add_argument("--index", help="history index in place of --history")
    e.add_argument("--k", type=int, default=3)
    e.set_defaults(fn=cmd_explain)

    args = p.parse_args(argv)
    if args.cmd == "stream" and not (args.kafka or args.source_dir):
        p.error("stream needs --source-dir or --kafka")
    return args.fn(args)


if __name__ == "__main__":
    sys.exit(main())
