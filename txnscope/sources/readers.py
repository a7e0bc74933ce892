"""Sources (typed / inferred CSV, Parquet, named tables) and sinks.

Writers always go through the DataFrame writer, so a lost executor only
re-runs its tasks and the commit protocol keeps half-written files invisible.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnscope.schema import TXN_COLUMNS, TXN_SCHEMA

CORRUPT = "_corrupt_record"
ROW_ID = "txn_id"


def header_schema(spark: SparkSession, path: str, needed: list[str]) -> T.StructType:
    """The declared types in the order of the file's header; columns that are not declared are text."""
    names = spark.read.option("header", True).csv(path).columns        # reads one line
    missing = sorted(set(needed) - set(names))
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}")
    declared = {f.name: f.dataType for f in TXN_SCHEMA.fields}
    return T.StructType([T.StructField(n, declared.get(n, T.StringType())) for n in names])


def nan_as_null(df: DataFrame) -> DataFrame:
    return df.withColumns({f.name: F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)) for f in df.schema.fields
                           if isinstance(f.dataType, (T.DoubleType, T.FloatType))})


# S1 ---------------------------------------------------------------------------
def read_transactions_csv(spark: SparkSession, path: str,
                          columns: list[str] | None = None) -> DataFrame:
    """Typed CSV scan with declared types and column selection by header name;
    input splits (``spark.sql.files.maxPartitionBytes``) replace fixed-size
    chunks.  A file whose header differs from the first one's raises.

    The rows have no id; training, replay and sampling read the table that
    ``load_transactions`` stores, where each row has one."""
    schema = header_schema(spark, path, columns or TXN_COLUMNS)
    df = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
    return df.select(*(columns or TXN_COLUMNS))


# S2 / S3 / S5 -----------------------------------------------------------------------
def load_raw(spark: SparkSession, path: str) -> DataFrame:
    """Inferred-schema CSV scan (exploration only: inference reads the data twice)."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def load_processed(spark: SparkSession, path: str) -> DataFrame:
    if path.rstrip("/").endswith(".csv"):
        return load_raw(spark, path)
    return spark.read.parquet(path)


# S4 ---------------------------------------------------------------------------
def read_collection(spark: SparkSession, name: str, fmt: str | None = None,
                    options: dict | None = None) -> DataFrame:
    """A named table (catalog) or, with ``fmt``, any connector; the store's
    internal ``_id`` column is dropped."""
    if fmt:
        df = spark.read.format(fmt).options(**(options or {})).load()
    else:
        df = spark.read.table(name)
    return df.drop("_id") if "_id" in df.columns else df


#: Wrappers of numbers, instants and ids in exported documents (extended JSON).
NUMBER_WRAPPERS = ("$numberInt", "$numberLong", "$numberDouble", "$numberDecimal")
DATE_WRAPPER, ID_WRAPPER = "$date", "$oid"


def unwrapped(raw: F.Column, kind: T.DataType) -> F.Column:
    """A field of an exported document, given as the text of its JSON value, as ``kind``; null if it is none."""
    inner = lambda key: F.get_json_object(raw, f"$['{key}']")                               # noqa: E731
    wrapped = raw.startswith("{")
    if isinstance(kind, T.StringType):
        return F.when(wrapped, F.coalesce(inner(ID_WRAPPER), raw)).otherwise(raw)
    if isinstance(kind, T.TimestampType):
        millis = F.get_json_object(raw, f"$['{DATE_WRAPPER}']['$numberLong']")
        return F.when(wrapped, F.coalesce(F.timestamp_millis(millis.try_cast("bigint")), inner(DATE_WRAPPER).try_cast(kind))) \
            .otherwise(raw.try_cast(kind))
    text = F.when(wrapped, F.coalesce(*[inner(k) for k in NUMBER_WRAPPERS])).otherwise(raw)
    # A whole number may be written as 3.0.
    return F.coalesce(text.try_cast(kind), text.try_cast("double").try_cast(kind)) if isinstance(kind, T.IntegralType) \
        else text.try_cast(kind)


def read_documents(spark: SparkSession, path: str, schema: T.StructType = TXN_SCHEMA,
                   where: dict[str, str] | None = None) -> DataFrame:
    """Documents of an exported collection, one extended-JSON object a line, with the fields of ``schema``.

    Numbers, instants and ids may stand plain or wrapped ({"$numberDouble": "1.5"}); ``_id`` and fields that are not
    asked for are not parsed.  ``where`` (field -> text) is a filter on plain text fields that the scan applies
    itself, before other fields are read."""
    raw = spark.read.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])).json(path)
    for name, value in (where or {}).items():
        raw = raw.where(F.col(name) == value)
    return raw.select(*[unwrapped(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields])


def write_documents(df: DataFrame, path: str, id_col: str = "txn_id") -> None:
    """Export as extended JSON with wrapped numbers and an ``_id``, as a document store's own tool writes it."""
    def wrap(f: T.StructField) -> F.Column:
        key = {"int": "$numberInt", "bigint": "$numberLong", "double": "$numberDouble"}.get(f.dataType.simpleString())
        if isinstance(f.dataType, T.TimestampType):
            key, value = DATE_WRAPPER, F.date_format(F.to_utc_timestamp(f.name, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
        else:
            value = F.col(f.name).cast("string")
        return F.when(F.col(f.name).isNotNull(), F.struct(value.alias(key))).alias(f.name) if key else F.col(f.name)
    oid = F.struct(F.substring(F.sha2(F.col(id_col).cast("string"), 256), 1, 24).alias(ID_WRAPPER)).alias("_id")
    df.select(oid, *[wrap(f) for f in df.schema.fields]).write.mode("overwrite").json(path)


# S8 ---------------------------------------------------------------------------
def has_rows(spark: SparkSession, name_or_path: str) -> bool:
    """True when the table (catalog name or Parquet path) exists and is not
    empty; ``isEmpty`` reads at most one row."""
    if "/" in name_or_path:
        # Ask Spark, not the driver's local disk: on a cluster the path lives
        # on the default file system (HDFS, object store).
        try:
            return not spark.read.parquet(name_or_path).isEmpty()
        except AnalysisException:       # path does not exist (or holds no table)
            return False
    return spark.catalog.tableExists(name_or_path) and not spark.table(name_or_path).isEmpty()


# K1 / K2 / K5 -----------------------------------------------------------------------
def write_table(df: DataFrame, target: str, mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """Overwrite (or append to) a result table: a path gets Parquet files, a
    bare name a catalog table."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if "/" in target:
        w.parquet(target)
    else:
        w.saveAsTable(target)


# K3 / K4 ----------------------------------------------------------------------
def split_valid(spark: SparkSession, csv_path: str,
                staging: str) -> tuple[DataFrame, DataFrame, dict]:
    """Read the CSV once in PERMISSIVE mode, write it partitioned by a reject
    flag, and return (accepted, rejected, counts) over that staging table.

    One pass over the input; good rows survive bad ones (the bulk-insert
    "keep going" behaviour), rejects keep their raw text and ``reasons``, one
    for each field that is not of its declared type, and the counts read
    one column of the stored table.  (An ``Observation`` would save that read,
    but a session that has used one can no longer serialise fitted models.)

    Each row gets ``txn_id`` from its input split and place in it: a retried
    task gives the same numbers, and the stored table fixes them."""
    declared = header_schema(spark, csv_path, TXN_COLUMNS)
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in declared.fields]).add(CORRUPT, T.StringType())
    raw = (spark.read.schema(as_text).option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False)
           .option("columnNameOfCorruptRecord", CORRUPT).csv(csv_path))
    kinds = {f.name: f.dataType for f in declared.fields if f.name in TXN_COLUMNS}
    typed = {n: F.col(n).try_cast(t) for n, t in kinds.items()}
    wrong = [F.when(F.col(n).isNotNull() & typed[n].isNull(), F.concat(F.lit(f"{n} is no {kinds[n].simpleString()}: "), F.col(n)))
             for n in TXN_COLUMNS if not isinstance(kinds[n], T.StringType)]
    # A row of another number of fields has its text in the corrupt column; its fields are not looked at.
    reasons = F.when(F.col(CORRUPT).isNotNull(), F.array(F.lit("another number of fields"))).otherwise(F.array_compact(F.array(*wrong)))
    line = F.coalesce(F.col(CORRUPT), F.to_csv(F.struct(*[f.name for f in declared.fields])))
    raw = raw.withColumn("reasons", reasons).withColumn(CORRUPT, F.when(F.size("reasons") > 0, line))
    raw = nan_as_null(raw.select(*[typed[n].alias(n) for n in TXN_COLUMNS], CORRUPT, "reasons")) \
        .withColumn(ROW_ID, F.monotonically_increasing_id())
    bad = F.col(CORRUPT).isNotNull()
    write_table(raw.withColumn("_rejected", bad.cast("int")), staging, partition_by=["_rejected"])
    staged = spark.read.parquet(staging)
    counts = staged.agg(F.count_if(F.col("_rejected") == 0).alias("accepted"),
                        F.count_if((F.col("_rejected") == 0) & (F.col("isFraud") == 1)).alias("fraud"),
                        F.count_if(F.col("_rejected") == 1).alias("rejected")).first().asDict()
    accepted = staged.filter(F.col("_rejected") == 0).drop(CORRUPT, "reasons", "_rejected")
    rejected = staged.filter(F.col("_rejected") == 1).select(CORRUPT, "reasons")
    return accepted, rejected, counts


def load_transactions(spark: SparkSession, csv_path: str, transactions: str, fraud_cases: str,
                      staging: str, quarantine: str | None = None, summary: str | None = None) -> dict:
    """Load the raw CSV into ``transactions`` and its fraud subset, skipping a
    table that already has rows (the whole load when both do).  Returns row
    counts of what was written.  ``summary`` names the per-type summary table,
    made anew from the stored transactions."""
    have_txn, have_fraud = has_rows(spark, transactions), has_rows(spark, fraud_cases)
    if have_txn and have_fraud:
        return {"skipped": True, "transactions": 0, "fraud_cases": 0, "rejected": 0}
    accepted, rejected, counts = split_valid(spark, csv_path, staging)
    out = {"skipped": False, "transactions": 0, "fraud_cases": 0,
           "rejected": int(counts["rejected"])}
    if not have_txn:
        write_table(accepted, transactions, mode="append")
        out["transactions"] = int(counts["accepted"])
    if not have_fraud:
        write_table(accepted.filter(F.col("isFraud") == 1), fraud_cases, mode="append")
        out["fraud_cases"] = int(counts["fraud"])
    if quarantine:
        write_table(rejected, quarantine, mode="append")
    if summary:
        from txnscope.operators.analytics import transaction_summary
        stored = spark.read.parquet(transactions) if "/" in transactions else spark.table(transactions)
        write_table(transaction_summary(stored), summary)
    return out


# K6 ---------------------------------------------------------------------------
def stable_uuid(*cols) -> F.Column:
    """UUID-shaped id from a hash of the key: the same on a task retry."""
    h = F.sha2(F.concat_ws("|", *[F.col(c).cast("string") if isinstance(c, str) else c
                                 for c in cols]), 256)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def encode_messages(df: DataFrame, id_col: str = "txn_id", ts_col: str | None = "ts") -> DataFrame:
    """Transactions as JSON message text: money rounded to 2 places, a stable
    uuid, an ISO-8601 UTC timestamp, the type decoded to its name."""
    from txnscope.functions import features as fx
    type_name = F.col("type") if "type" in df.columns else fx.type_decoded("type_encoded")
    at = F.col(ts_col) if ts_col else F.current_timestamp()
    if not ts_col or dict(df.dtypes)[ts_col] == "timestamp":     # an instant, shown in the session's zone
        at = F.to_utc_timestamp(at, F.current_timezone())
    ts = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    money = ["amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest"]
    body = F.struct(
        stable_uuid(id_col).alias("transaction_id"), ts.alias("timestamp"),
        type_name.alias("type"),
        *[F.round(F.col(m), 2).alias(m) for m in money],
        F.col("isFraud").cast("int").alias("isFraud"),
        F.col("isFlaggedFraud").cast("int").alias("isFlaggedFraud"),
        *[F.col(x) for x in ("nameOrig", "nameDest") if x in df.columns])
    return df.select(stable_uuid(id_col).alias("key"), F.to_json(body).alias("value"))
