"""Small helpers shared by the training-data operators.

Conventions all operators follow: a null text is an empty text, input columns
are taken by name (extra columns never clash with computed ones because only
the named columns enter the work), and intermediate tables go to the shared
folder that ``spark.checkpoint.dir`` names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six ASCII white-space characters that separate words.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the words of a text (runs of characters that are no ASCII white space)."""
    flat = F.translate(text, SPACES[1:], " " * (len(SPACES) - 1))
    return F.filter(F.split(flat, " "), lambda w: w != "")


def text_bytes(df: DataFrame, col: str = "text") -> int:
    """Bytes of all texts; sizes blocks and shards so that they hold a fixed amount at any scale."""
    return df.select(F.coalesce(F.sum(F.octet_length(F.col(col)).cast("long")), F.lit(0))).first()[0]


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it (upper and lower case alike)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
