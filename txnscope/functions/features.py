"""Per-row feature columns (pure Column expressions, JVM-side, codegen-able).

Every function takes and returns ``Column``s so the same definition is used by
batch analyses, training, batch scoring and the stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnscope.schema import (HELPER_FEATURES, MODEL_FEATURES, ROUND_UNIT, TARGET,
                             TYPE_CODES, UNKNOWN_TYPE_CODE, UNKNOWN_TYPE_NAME)


def c(name: str) -> Column:
    return F.col(name)


# P4 / P5 -----------------------------------------------------------------
def type_encoded(type_col: Column | str = "type") -> Column:
    """Label-encode the transaction type; unknown (or null) types give -1."""
    t = c(type_col) if isinstance(type_col, str) else type_col
    lookup = F.create_map(*[x for k, v in TYPE_CODES.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(lookup, t), F.lit(UNKNOWN_TYPE_CODE)).cast("int")


def type_decoded(code_col: Column | str = "type_encoded") -> Column:
    """Inverse of ``type_encoded``; unknown codes give UNKNOWN."""
    code = c(code_col) if isinstance(code_col, str) else code_col
    lookup = F.create_map(*[x for k, v in TYPE_CODES.items() for x in (F.lit(v), F.lit(k))])
    return F.coalesce(F.try_element_at(lookup, code.cast("int")), F.lit(UNKNOWN_TYPE_NAME))


# F1 - F8 -----------------------------------------------------------------
def balance_diff_orig() -> Column:
    return c("oldbalanceOrg") - c("newbalanceOrig")


def balance_diff_dest() -> Column:
    return c("newbalanceDest") - c("oldbalanceDest")


def error_balance_orig() -> Column:
    return c("oldbalanceOrg") - c("amount") - c("newbalanceOrig")


def error_balance_dest() -> Column:
    return c("oldbalanceDest") + c("amount") - c("newbalanceDest")


def amount_log() -> Column:
    return F.log1p(c("amount"))


def amount_to_balance_ratio() -> Column:
    # Null instead of an ANSI divide-by-zero error when oldbalanceOrg == -1.
    return F.try_divide(c("amount"), c("oldbalanceOrg") + F.lit(1.0))


def is_round_amount() -> Column:
    return (c("amount") % ROUND_UNIT == 0).cast("int")


def zero_orig_balance() -> Column:
    return (c("oldbalanceOrg") == 0).cast("int")


# F9 / F10 / P12 ------------------------------------------------------------
def helper_features(df: DataFrame) -> DataFrame:
    """Exploratory feature set: input columns plus encoded type and five derived."""
    return df.withColumns({
        "type_encoded": type_encoded(),
        "amount_log": amount_log(),
        "balance_diff_orig": balance_diff_orig(),
        "balance_diff_dest": balance_diff_dest(),
        "error_balance_orig": error_balance_orig(),
        "error_balance_dest": error_balance_dest(),
    })


def model_features(df: DataFrame) -> DataFrame:
    """Feature set the classifier uses.  Accepts a string ``type`` or an
    already-encoded ``type_encoded`` column."""
    enc = type_encoded() if "type" in df.columns else c("type_encoded").cast("int")
    return df.withColumns({
        "type_encoded": enc,
        "balance_diff_orig": balance_diff_orig(),
        "balance_diff_dest": balance_diff_dest(),
        "amount_to_balance_ratio": amount_to_balance_ratio(),
        "is_round_amount": is_round_amount(),
        "zero_orig_balance": zero_orig_balance(),
    })


def features_and_target(df: DataFrame, features: list[str] = HELPER_FEATURES,
                        engineer=helper_features) -> DataFrame:
    """Typed projection to the feature columns (double) and the label (int)."""
    out = engineer(df)
    return out.select(*[c(f).cast("double").alias(f) for f in features],
                      c(TARGET).cast("int").alias(TARGET))


def model_matrix(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Model features as doubles, plus any pass-through columns."""
    out = model_features(df)
    return out.select(*(keep or []), *[c(f).cast("double").alias(f) for f in MODEL_FEATURES])


# F17 - F20 -----------------------------------------------------------------
def money2(col: Column | str) -> Column:
    x = c(col) if isinstance(col, str) else col
    return F.round(x, 2)


def file_stamp(ts: Column) -> Column:
    """``YYYYMMDD_HHMMSS`` stamp."""
    return F.date_format(ts, "yyyyMMdd_HHmmss")


def display_time(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def parse_iso(s: Column) -> Column:
    """ISO-8601 text (with or without offset) to a timestamp."""
    return F.coalesce(F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")),
                      F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSS")),
                      F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")),
                      F.try_to_timestamp(s))


def short_id(col: Column | str) -> Column:
    x = c(col) if isinstance(col, str) else col
    return F.substring(x, 1, 8)


def money_text(col: Column | str, places: int = 0) -> Column:
    x = c(col) if isinstance(col, str) else col
    return F.format_number(x, places)


def unusable_inputs(names) -> Column:
    """Names of the columns that are null or NaN, comma-separated; null if there are none."""
    bad = F.array_compact(F.array(*[
        F.when(F.nanvl(F.col(n).cast("double"), F.lit(None).cast("double")).isNull(), F.lit(n)) for n in names]))
    return F.when(F.size(bad) > 0, F.array_join(bad, ","))
