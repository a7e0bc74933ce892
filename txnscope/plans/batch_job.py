"""Batch jobs: the five analyses + cleaned export, the summary table, training.

Each analysis is its own lazily built plan over the Parquet source.  The
shared input is *not* cached: every plan reads only the columns it needs
(Parquet column pruning, filter push-down), which at 100 TB is cheaper and
safer than pinning the whole table in executor memory.  Results are small
(per type / step / bucket / top-n) except the drain rows and the export,
which are written by the executors directly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txnscope.operators import analytics as an
from txnscope.sources.readers import write_table

ANALYSES = {
    "spark_type_stats": an.type_stats,
    "spark_hourly_stats": an.hourly_pattern,
    "spark_high_risk_senders": an.high_risk_senders,
    "spark_amount_distribution": an.amount_distribution,
    "spark_drain_transactions": an.drain_transactions,
}


def analysis_plans(txns: DataFrame) -> dict[str, DataFrame]:
    plans = {name: fn(txns) for name, fn in ANALYSES.items()}
    plans["transaction_summary"] = an.transaction_summary(txns)
    return plans


def run_analyses(spark: SparkSession, txns: DataFrame, out_dir: str,
                 export: bool = True) -> dict[str, str]:
    """Write every analysis as an overwritten result table under ``out_dir``;
    returns table -> path."""
    out = {}
    for name, plan in analysis_plans(txns).items():
        path = f"{out_dir.rstrip('/')}/{name}"
        write_table(plan, path)
        out[name] = path
    if export:
        path = f"{out_dir.rstrip('/')}/cleaned.parquet"
        write_table(an.cleaned_export(txns), path)
        out["cleaned"] = path
    return out


def train_and_save(txns: DataFrame, out_dir: str, spec=None) -> dict[str, str]:
    """Compare the classifiers, save the best pipeline, the report (JSON) and
    the ROC points (Parquet)."""
    from txnscope.learning import models as M
    cmp = M.compare_models(txns, spec)
    base = out_dir.rstrip("/")
    M.save_model(cmp.best_model, f"{base}/model")
    cmp.report.coalesce(1).write.mode("overwrite").json(f"{base}/model_comparison")
    write_table(cmp.roc_points, f"{base}/roc_points")
    return {"model": f"{base}/model", "report": f"{base}/model_comparison",
            "roc_points": f"{base}/roc_points", "best": cmp.best_name}


def evaluate_and_save(model, txns: DataFrame, out_dir: str, threshold: float = 0.5) -> dict[str, str]:
    """Evaluate a fitted pipeline on labelled transactions at a decision threshold and write the metrics,
    the per-class report, the ROC and precision-recall points and the feature importances.

    The transactions are scored once; every table is made from the stored (label, score) rows.  Rows whose
    model inputs are null or NaN have no score; they are counted as ``unscored`` and enter no other figure."""
    from pyspark.sql import functions as F

    from txnscope.learning import models as M
    from txnscope.operators import metrics as me
    from txnscope.schema import TARGET
    from txnscope.session import materialize
    spark, base = txns.sparkSession, out_dir.rstrip("/")
    scored = materialize(M.scored_features(model, txns).select(
        F.col(TARGET).cast("int").alias("label"), "score"), "evaluation-scores")
    usable = scored.where("score is not null and label is not null")
    decided = usable.withColumn("prediction", me.decide("score", threshold))
    unscored = scored.agg(F.count_if(F.col("score").isNull() | F.col("label").isNull()).alias("unscored"))
    one_row = me.classification_metrics(decided).crossJoin(me.roc_auc(usable)) \
        .crossJoin(me.average_precision(usable)).crossJoin(unscored).withColumn("threshold", F.lit(float(threshold)))
    tables = {"metrics": one_row, "per_class": me.per_class_report(decided), "roc_points": me.roc_curve(usable),
              "pr_points": me.pr_curve(usable).select("threshold", "precision", "recall"),
              "importances": M.importance_table(spark, M.feature_importance(model))}
    for name, df in tables.items():
        write_table(df, f"{base}/{name}")
    return {name: f"{base}/{name}" for name in tables}
