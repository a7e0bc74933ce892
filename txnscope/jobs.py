"""The jobs from a command line: ``python -m txnscope.jobs <job> ...`` or ``spark-submit txnscope/jobs.py <job> ...``.

    load      CSV files -> transactions, fraud cases, summary, rejects with reasons
    analyse   transactions -> the analysis tables and the cleaned export
    train     transactions -> best model, comparison report, curves
    evaluate  a saved model on labelled transactions at a threshold
    score     a saved model on transactions -> predictions with risk levels
    replay    transactions -> messages, all or a shuffled first n
    consume   messages -> alerts, rejects, statistics; bounded with --once

Paths are those of any file system that Spark reads; master and resources come from spark-submit.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from txnscope.session import build_session
from txnscope.sources import readers


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="txnscope", description="Transaction-fraud analytics on Spark")
    top.add_argument("--master", help="only for local runs; spark-submit sets it otherwise")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, *paths: str) -> argparse.ArgumentParser:
        p = jobs.add_parser(name)
        for x in paths:
            p.add_argument(x)
        return p
    job("load", "csv", "out")
    job("analyse", "transactions", "out").add_argument("--no-export", action="store_true")
    train = job("train", "transactions", "out")
    train.add_argument("--models", nargs="+", help="names of the classifiers to compare")
    for name in ("rf_trees", "rf_depth", "gbt_iter", "gbt_depth", "lr_iter"):
        train.add_argument("--" + name.replace("_", "-"), type=int)
    job("evaluate", "model", "transactions", "out").add_argument("--threshold", type=float, default=0.5)
    job("score", "model", "transactions", "out")
    replay = job("replay", "transactions", "out")
    replay.add_argument("--limit", type=int)
    replay.add_argument("--seed", type=int, default=42)
    consume = job("consume", "messages", "out")
    consume.add_argument("--model", help="a saved model; without one the rule score decides")
    consume.add_argument("--once", action="store_true", help="process what is there, then stop")
    consume.add_argument("--watermark", default="1 hour")
    return top


def run(spark: SparkSession, args: argparse.Namespace) -> dict:
    """Run one job; returns what it made."""
    from txnscope.learning import models as M
    from txnscope.plans import batch_job
    from txnscope.streaming import consumer as W
    out = args.out.rstrip("/")
    if args.job == "load":
        return readers.load_transactions(spark, args.csv, f"{out}/transactions", f"{out}/fraud_cases", f"{out}/staging",
                                         f"{out}/rejects", f"{out}/transaction_summary")
    if args.job == "analyse":
        return batch_job.run_analyses(spark, spark.read.parquet(args.transactions), out, export=not args.no_export)
    if args.job == "train":
        given = {k: v for k, v in vars(args).items() if k in M.ModelSpec.__dataclass_fields__ and v is not None}
        spec = M.ModelSpec(**given, **({"names": args.models} if args.models else {}))
        return batch_job.train_and_save(spark.read.parquet(args.transactions), out, spec)
    if args.job == "evaluate":
        return batch_job.evaluate_and_save(M.load_model(args.model), spark.read.parquet(args.transactions), out, args.threshold)
    if args.job == "score":
        readers.write_table(M.score_transactions(M.load_model(args.model), spark.read.parquet(args.transactions)), out)
        return {"scores": out}
    if args.job == "replay":
        W.replay_messages(spark.read.parquet(args.transactions), out, args.limit, args.seed)
        return {"messages": out}
    scorer = W.model_scorer(M.load_model(args.model)) if args.model else W.rule_scorer()
    handles = W.start_consumer(spark, W.message_source(spark, args.messages), scorer, f"{out}/alerts", f"{out}/stats",
                               f"{out}/checkpoint", f"{out}/rejects", watermark=args.watermark,
                               trigger={"availableNow": True} if args.once else None)
    for h in handles:
        h.awaitTermination()
    return W.final_totals(spark, f"{out}/stats").drop("recorded_at").first().asDict()


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = build_session(args.master)
    try:
        print(json.dumps(run(spark, args), default=str))
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
