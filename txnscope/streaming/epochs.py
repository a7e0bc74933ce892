"""A table that a stream writes by epoch: retries replace, closed epochs merge.

``<path>/open/day=D/epoch=N`` holds the rows of one epoch.  Once ``keep`` epochs
are open, those before the running one are closed: their rows join their day's
table, which is written anew as ``<path>/days/day=D/through=N`` in one file.
The name says which epochs are in it, so a reader, and a writer that is
restarted between writing and deleting, takes every epoch exactly once: the
newest complete table of each day and the open epochs behind it.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from txnscope.session import children, is_complete, remove


class EpochTable:
    def __init__(self, spark: SparkSession, path: str, keep: int = 64):
        self.spark, self.path, self.keep = spark, path.rstrip("/"), keep

    def _numbered(self, folder: str, name: str) -> list[int]:
        return [int(x.split("=")[1]) for x in children(self.spark, folder) if x.startswith(f"{name}=")]

    def _open(self) -> list[tuple[int, str]]:
        """(epoch, day) of the open epochs, in order."""
        days = [x for x in children(self.spark, f"{self.path}/open") if x.startswith("day=")]
        found = [(n, d) for d in days for n in self._numbered(f"{self.path}/open/{d}", "epoch")
                 if is_complete(self.spark, f"{self.path}/open/{d}/epoch={n}")]
        through = self._through()
        return sorted((n, d) for n, d in found if n > through.get(d, -1))

    def _through(self) -> dict[str, int]:
        """Last merged epoch of each day that has a complete table."""
        out = {}
        for d in children(self.spark, f"{self.path}/days"):
            done = [n for n in self._numbered(f"{self.path}/days/{d}", "through")
                    if is_complete(self.spark, f"{self.path}/days/{d}/through={n}")]
            if done:
                out[d] = max(done)
        return out

    def write(self, rows: DataFrame, epoch: int, at: datetime) -> None:
        """Replace the rows of ``epoch``, which began at ``at``."""
        day = f"day={at:%Y-%m-%d}"
        for n, d in self._open():
            if n == epoch and d != day:                             # an attempt before midnight
                remove(self.spark, f"{self.path}/open/{d}/epoch={n}")
        rows.write.mode("overwrite").parquet(f"{self.path}/open/{day}/epoch={epoch}")

    def compact(self, epoch: int) -> None:
        """Merge open epochs before ``epoch``, the running one, once there are ``keep``."""
        closed = [(n, d) for n, d in self._open() if n < epoch]
        if len(closed) < self.keep:
            return
        through = self._through()
        for day in sorted({d for _, d in closed}):
            mine = [n for n, d in closed if d == day]
            paths = [f"{self.path}/open/{day}/epoch={n}" for n in mine]
            if day in through:
                paths.append(f"{self.path}/days/{day}/through={through[day]}")
            self.spark.read.parquet(*paths).coalesce(1).write.mode("overwrite") \
                .parquet(f"{self.path}/days/{day}/through={max(mine)}")
            for p in paths:
                remove(self.spark, p)

    def paths(self) -> list[str]:
        merged = [f"{self.path}/days/{d}/through={n}" for d, n in sorted(self._through().items())]
        return merged + [f"{self.path}/open/{d}/epoch={n}" for n, d in self._open()]

    def read(self) -> DataFrame:
        return self.spark.read.parquet(*self.paths())

    def last(self, before: int) -> Row | None:
        """The row of the latest epoch before ``before`` (one row an epoch, with a column ``epoch``)."""
        paths = self.paths()
        return self.spark.read.parquet(*paths).where(F.col("epoch") < before).orderBy(F.desc("epoch")).first() \
            if paths else None
