"""Structured Streaming: score a transaction message stream, append alerts,
keep running statistics (W1-W9, S6, K6-K8).

One query does it all in one pass.  Each micro-batch is parsed once, messages
seen within the watermark are set aside, the rest is scored once and stored;
alerts, rejects and the running totals are read from that.  Every output is
written by epoch and replaced when an epoch is tried again, and the totals of
an epoch start from the stored ones of the epoch before, so a restart or a
lost executor neither loses a message nor counts one twice.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnscope.functions import exact
from txnscope.functions import features as fx
from txnscope.functions import rules
from txnscope.schema import MESSAGE_SCHEMA, MODEL_FEATURES, RAW_SCORING_FIELDS, STATS_INTERVAL_SECONDS
from txnscope.session import children, is_complete, remove
from txnscope.streaming.epochs import EpochTable

c = F.col
Scorer = Callable[[DataFrame], DataFrame]   # adds "prediction" (int) and "p" (probability)
#: What one micro-batch takes in unless the caller says otherwise; a long backlog is read in many.
FILES_PER_TRIGGER = 1000
OFFSETS_PER_TRIGGER = 5_000_000


# S6 ---------------------------------------------------------------------------
def message_source(spark: SparkSession, path: str | None = None,
                   kafka: dict | None = None, max_files: int = FILES_PER_TRIGGER) -> DataFrame:
    """Raw messages as a ``value`` string column: Kafka when ``kafka`` options
    are given (earliest offsets by default), else a folder of JSON-lines files.
    Either is read in micro-batches of bounded size."""
    if kafka:
        opts = {"startingOffsets": "earliest", "maxOffsetsPerTrigger": str(OFFSETS_PER_TRIGGER), **kafka}
        return spark.readStream.format("kafka").options(**opts).load() \
            .select(c("value").cast("string").alias("value"))
    return spark.readStream.format("text").option("maxFilesPerTrigger", max_files).load(path)


# W1 / P10 ---------------------------------------------------------------------------
def parse_messages(raw: DataFrame, arrival: Column | None = None) -> DataFrame:
    """JSON text -> typed columns; ``cause`` tells why a message cannot be scored, ``_valid`` marks those that can."""
    parsed = raw.select(F.from_json("value", MESSAGE_SCHEMA).alias("m"), "value") \
        .select("m.*", "value")
    # A message without an id is named by its content; one whose model inputs cannot be computed is not valid.
    h = F.sha2(c("value"), 256)
    parsed = parsed.withColumn("transaction_id", F.coalesce("transaction_id", F.concat(F.lit("content-"), h)))
    needed = ["type", *RAW_SCORING_FIELDS]
    missing = F.array_compact(F.array(*[F.when(c(f).isNull(), F.lit(f)) for f in dict.fromkeys(needed)]))
    columns = parsed.columns
    cause = F.when(F.size(missing) == len(dict.fromkeys(needed)), F.lit("no transaction")) \
        .when(F.size(missing) > 0, F.concat(F.lit("missing "), F.array_join(missing, ","))) \
        .otherwise(F.concat(F.lit("unusable "), fx.unusable_inputs(MODEL_FEATURES)))
    parsed = fx.model_features(parsed).withColumn("cause", cause).select(*columns, "cause")
    # A message without a readable timestamp is stamped on arrival (as the original consumer does).
    return parsed.withColumn("_valid", c("cause").isNull()) \
        .withColumn("event_time", F.coalesce(fx.parse_iso(c("timestamp")),
                                             arrival if arrival is not None else F.current_timestamp()))


def first_arrivals(valid: DataFrame) -> DataFrame:
    """W6: one message of each transaction id in a micro-batch, the same one whenever the batch is read again.

    A partial aggregate, so an id that holds a third of a batch costs one row a task."""
    rest = [x for x in valid.columns if x != "transaction_id"]
    one = F.min_by(F.struct(*rest), F.struct("event_time", "value")).alias("m")
    return valid.groupBy("transaction_id").agg(one).select("transaction_id", "m.*")


# W2 ---------------------------------------------------------------------------
def model_scorer(model) -> Scorer:
    """Score with a fitted pipeline; a linear one runs as compiled expressions."""
    from txnscope.learning.models import scored_features

    def score(df: DataFrame) -> DataFrame:
        return scored_features(model, df).withColumnRenamed("score", "p")
    return score


def rule_scorer(threshold: float = 0.5) -> Scorer:
    """Model-free scorer (tests, checks): the deterministic rule confidence."""
    def score(df: DataFrame) -> DataFrame:
        return df.withColumn("p", rules.rule_confidence()) \
            .withColumn("prediction", (c("p") >= threshold).cast("int"))
    return score


def score_messages(valid: DataFrame, scorer: Scorer, keep: list[str] | None = None) -> DataFrame:
    scored = scorer(valid)
    return scored.select(
        "transaction_id", "timestamp", "event_time", "type", "amount", "nameOrig", "nameDest",
        *[x for x in ("oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest")],
        "prediction", F.round(c("p"), 4).alias("confidence"),
        rules.risk_level("p").alias("risk_level"), rules.flags().alias("flags"), *(keep or []))


# W3 / K7 ---------------------------------------------------------------------------
def alert_rows(scored: DataFrame, saved_at: Column | None = None) -> DataFrame:
    return scored.filter(c("prediction") == 1).select(
        "transaction_id", "type", "amount", "confidence", "risk_level", "flags",
        c("event_time").alias("timestamp"), "nameOrig", "nameDest",
        (saved_at if saved_at is not None else F.current_timestamp()).alias("saved_at"))


# W4 ---------------------------------------------------------------------------
def running_totals(scored: DataFrame) -> DataFrame:
    """Totals of scored messages: processed, frauds, exact sum of the 4-place
    confidences of frauds (in 1e-4 units)."""
    return scored.agg(
        F.count(F.lit(1)).alias("processed"),
        F.count_if(c("prediction") == 1).alias("fraud_count"),
        F.coalesce(exact.units_sum(F.when(c("prediction") == 1, c("confidence")), 4),
                   F.lit(0).cast("decimal(28,0)")).alias("conf_sum"))


#: Columns of a stats row.
SNAPSHOT = ["processed", "fraud_count", "fraud_rate", "avg_confidence", "recorded_at"]


def snapshot(totals: DataFrame, recorded_at: Column | None = None, keep: list[str] | None = None) -> DataFrame:
    """Stats row: fraud rate (%, 4 places) and mean fraud confidence (%, 4 places);
    ``conf_sum`` counts 1e-4 confidence units.  Columns named in ``keep`` stay."""
    q = c("conf_sum").cast("decimal(38,0)")
    f = c("fraud_count").cast("decimal(38,0)")
    num = q * F.lit(2 * 100 * 10000) + f * 10000
    den = f * 2 * 10000
    avg_conf = F.when(c("fraud_count") == 0, F.lit(0.0)).otherwise(
        ((num - num % den) / den).cast("long").cast("double") / F.lit(10000.0))
    return totals.select(
        c("processed").cast("long").alias("processed"),
        c("fraud_count").cast("long").alias("fraud_count"),
        exact.pct(c("fraud_count"), c("processed"), 4).alias("fraud_rate"),
        avg_conf.alias("avg_confidence"),
        (recorded_at if recorded_at is not None else F.current_timestamp()).alias("recorded_at"), *(keep or []))


# running the job -------------------------------------------------------------------
#: How long alert counts are kept in the state of a snapshot.
RING = timedelta(hours=1)
#: Running counts; each epoch adds its own to those of the epoch before.
COUNTS = ["messages", "rejects", "duplicates", "processed", "fraud_count", "conf_sum"]
STATE = {"epoch": "bigint", **dict.fromkeys(COUNTS, "bigint"), "conf_sum": "decimal(38,0)", "recorded_at": "timestamp",
         "last_5m": "bigint", "last_1h": "bigint", "recent": "array<struct<at: timestamp, n: bigint>>"}


def utc(t: datetime) -> datetime:
    """An instant with its zone; Spark's rows hold instants as local times without one."""
    return t.astimezone(timezone.utc)


def span(text: str) -> timedelta:
    """'1 hour', '90 seconds', ... as a time span."""
    n, unit = re.fullmatch(r"\s*(\d+)\s*(second|minute|hour|day|week)s?\s*", text.lower()).groups()
    return timedelta(**{f"{unit}s": int(n)})


class Epochs:
    """What is done with each micro-batch; see ``start_consumer``."""

    def __init__(self, spark: SparkSession, scorer: Scorer, alerts_path: str, stats_path: str, checkpoint: str,
                 rejects_path: str, watermark: str):
        self.spark, self.scorer, self.watermark = spark, scorer, span(watermark)
        self.alerts, self.rejects, self.work = alerts_path.rstrip("/"), rejects_path.rstrip("/"), f"{checkpoint}/scored"
        self.stats = EpochTable(spark, stats_path)
        self.before: dict = {}

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        last = self.before if self.before.get("epoch") == epoch - 1 else self._stored(epoch)
        now = max([datetime.now(timezone.utc), *[utc(last[k]) for k in ("recorded_at",) if k in last]])
        parsed = parse_messages(batch.where("value is not null"), F.lit(now).cast("timestamp")).persist()
        try:
            scored = self._score(parsed, epoch, now)
            self.before = self._record(parsed, scored, last, epoch, now)
        finally:
            parsed.unpersist()
        self.stats.compact(epoch)

    def _stored(self, epoch: int) -> dict:
        row = self.stats.last(epoch)
        return row.asDict(recursive=True) if row else {}

    def _score(self, parsed: DataFrame, epoch: int, now: datetime) -> DataFrame:
        """The new messages of the epoch with their verdicts, scored once and stored."""
        new = first_arrivals(parsed.where("_valid"))
        seen = []
        for name in children(self.spark, self.work):
            n, at = (int(x[1:]) for x in name.split("-"))
            path = f"{self.work}/{name}"
            if n >= epoch or datetime.fromtimestamp(at / 1000, timezone.utc) < now - self.watermark:
                remove(self.spark, path)                        # an earlier attempt, or older than the watermark
            elif is_complete(self.spark, path):
                seen.append(path)
        if seen:
            new = new.join(self.spark.read.parquet(*seen).select("transaction_id"), "transaction_id", "left_anti")
        scored = score_messages(new, self.scorer, keep=["value"])
        failed = c("prediction").isNull()
        path = f"{self.work}/e{epoch}-t{int(now.timestamp() * 1000)}"
        scored.withColumn("value", F.when(failed, c("value"))).write.parquet(path)
        return self.spark.read.parquet(path)

    def _put(self, rows: DataFrame, path: str, epoch: int, n: int) -> None:
        # The first epoch writes even without rows, so that the table can be read from then on.
        if n or not epoch:
            rows.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")
        else:
            remove(self.spark, f"{path}/epoch={epoch}")

    def _record(self, parsed: DataFrame, scored: DataFrame, last: dict, epoch: int, now: datetime) -> dict:
        seen = parsed.agg(F.count("*").alias("messages"), F.count_if("_valid").alias("valid")).first()
        made = running_totals(scored.where("prediction is not null")).first()
        failed = scored.where("prediction is null").count() if made.processed < seen.valid else 0
        at = F.lit(now).cast("timestamp")
        self._put(alert_rows(scored, at), self.alerts, epoch, made.fraud_count)
        bad = parsed.where("not _valid").select("value", "cause").unionByName(
            scored.where("prediction is null").select("value", F.lit("no score").alias("cause")))
        rejects = seen.messages - seen.valid + failed
        self._put(bad.withColumn("rejected_at", at), self.rejects, epoch, rejects)
        recent = [{"at": utc(r["at"]), "n": r["n"]} for r in last.get("recent", []) if utc(r["at"]) >= now - RING]
        recent += [{"at": now, "n": made.fraud_count}] if made.fraud_count else []
        total = {"epoch": epoch, "recorded_at": now, "recent": recent,
                 "messages": seen.messages, "rejects": rejects, "duplicates": seen.valid - failed - made.processed,
                 "processed": made.processed, "fraud_count": made.fraud_count, "conf_sum": made.conf_sum}
        for k in COUNTS:
            total[k] += last.get(k, 0)
        total["last_5m"] = sum(r["n"] for r in recent if r["at"] >= now - timedelta(minutes=5))
        total["last_1h"] = sum(r["n"] for r in recent)
        row = self.spark.createDataFrame([tuple(total[k] for k in STATE)], ", ".join(f"{k} {t}" for k, t in STATE.items()))
        self.stats.write(snapshot(row.coalesce(1), c("recorded_at"), [k for k in STATE if k not in SNAPSHOT]), epoch, now)
        return total


def start_consumer(spark: SparkSession, raw: DataFrame, scorer: Scorer, alerts_path: str,
                   stats_path: str, checkpoint: str, rejects_path: str | None = None,
                   trigger: dict | None = None, watermark: str = "1 hour", heartbeat: bool | None = None) -> list:
    """Start the consumer; returns its handles.

    Messages that cannot be scored go with their cause to ``rejects_path``, by
    default beside the alerts (``<alerts_path>-rejects``), so that none is
    lost: processed + rejects + duplicates = messages.  A transaction id that
    arrived within ``watermark`` before is a duplicate, by arrival time, so
    that a transaction with an old timestamp is not lost.

    ``trigger`` defaults to a 60 s processing-time trigger (W5); pass
    ``{"availableNow": True}`` for a bounded run (W9).  With ``heartbeat``, the
    default for the default trigger, an idle stream records snapshots too."""
    heartbeat = trigger is None if heartbeat is None else heartbeat
    trigger = trigger or {"processingTime": f"{STATS_INTERVAL_SECONDS} seconds"}
    if heartbeat:                       # one row a second without a message makes every trigger an epoch
        tick = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
        raw = raw.select("value").unionByName(tick.select(F.lit(None).cast("string").alias("value")))
    rejects_path = rejects_path or f"{alerts_path.rstrip('/')}-rejects"
    work = Epochs(spark, scorer, alerts_path, stats_path, checkpoint, rejects_path, watermark)
    return [raw.writeStream.foreachBatch(work).option("checkpointLocation", f"{checkpoint}/consumer")
            .trigger(**trigger).queryName("fraud_consumer").start()]


def run_bounded(spark: SparkSession, raw: DataFrame, scorer: Scorer, alerts_path: str,
                stats_path: str, checkpoint: str, rejects_path: str | None = None) -> None:
    """Process everything available now, then stop (W9)."""
    for h in start_consumer(spark, raw, scorer, alerts_path, stats_path, checkpoint,
                            rejects_path, trigger={"availableNow": True}):
        h.awaitTermination()


# W8 ---------------------------------------------------------------------------
def windowed_alert_counts(alerts_stream: DataFrame, width: str = "5 minutes",
                          watermark: str = "10 minutes") -> DataFrame:
    """Alerts per tumbling window of saved_at (in-stream form of the rolling counts)."""
    return alerts_stream.withWatermark("saved_at", watermark) \
        .groupBy(F.window("saved_at", width)).agg(F.count(F.lit(1)).alias("alerts"))


# K7 ---------------------------------------------------------------------------
def read_alerts(spark: SparkSession, alerts_path: str) -> DataFrame:
    """The alert table, without the epoch that its folders name."""
    return spark.read.parquet(alerts_path).drop("epoch")


# W7 ---------------------------------------------------------------------------
def read_stats(spark: SparkSession, stats_path: str) -> DataFrame:
    return EpochTable(spark, stats_path).read().select(*SNAPSHOT)


def read_accounts(spark: SparkSession, stats_path: str) -> DataFrame:
    """What has become of the messages, and the rolling alert counts (W8), at each snapshot."""
    return EpochTable(spark, stats_path).read().select("epoch", "messages", "processed", "rejects", "duplicates",
                                                       "last_5m", "last_1h", "recorded_at")


def final_totals(spark: SparkSession, stats_path: str) -> DataFrame:
    stats = EpochTable(spark, stats_path).read()
    return stats.agg(F.max_by(F.struct(*SNAPSHOT), "epoch").alias("s")).select("s.*")


# K6 / P7 / W9: the replay side ---------------------------------------------------------
def replay_messages(txns: DataFrame, out_dir: str | None, limit: int | None = None,
                    seed: int = 42, id_col: str = "txn_id", kafka: dict | None = None) -> None:
    """Write transactions as messages, bounded to the first ``limit`` in
    seeded-hash order: JSON lines under ``out_dir``, or (key, value) records
    to a Kafka topic when ``kafka`` options (``kafka.bootstrap.servers``,
    ``topic``) are given."""
    from txnscope.operators.analytics import first_n_by_hash
    from txnscope.sources.readers import encode_messages
    chosen = txns if limit is None else first_n_by_hash(txns, limit, id_col, seed)
    messages = encode_messages(chosen, id_col, "ts" if "ts" in chosen.columns else None)
    if kafka:
        messages.write.format("kafka").options(**kafka).save()
    else:
        messages.select("value").write.mode("append").text(out_dir)
