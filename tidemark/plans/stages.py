"""Stages of an experiment that are kept and used again.

A stage is a table by as-of date whose place is named by what it is made of: its settings, and the
version of the data it reads. A run with the same settings and data reads what is there; a run
with further dates computes only those. Feature stages also keep the states of all entities at
their last date, from which later dates go on: only newer rows and rows inside windows are read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.dates import to_date
from tidemark.operators.features import Carried, FeatureSource, build_features, history_state


def data_version(df: DataFrame | None) -> str:
    """A name for the data behind a frame: its plan, and path, size and time of every file read.

    Frames that don't come from files alone have a new version every time, so that nothing made
    of them is ever used again.
    """
    if df is None:
        return "none"
    plan = df._jdf.queryExecution().analyzed().canonicalized().toString()
    files = sorted(df.inputFiles())
    if not files or re.search(r"LogicalRDD|LocalRelation|truncated fields", plan):
        return uuid.uuid4().hex
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    h = hashlib.sha256(plan.encode())
    for name in files:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        status = path.getFileSystem(conf).getFileStatus(path)
        h.update(f"{name} {status.getLen()} {status.getModificationTime()}\n".encode())
    return h.hexdigest()


def stage_key(*parts) -> str:
    return hashlib.sha256("\n".join(map(repr, parts)).encode()).hexdigest()[:16]


class Stages:
    """Kept tables below a folder that all executors reach."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.computed: list[tuple[str, list[date]]] = []  # what this run had to make

    def _read(self, path: str) -> DataFrame | None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        there = p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)
        return self.spark.read.parquet(path) if there else None

    def _dates(self, path: str) -> list[date]:
        done = self._read(path)
        return [] if done is None else sorted({r.as_of_date for r in done.collect()})

    def _note(self, path: str, days: Sequence[date]) -> None:
        self.spark.createDataFrame([(d,) for d in days], "as_of_date date").coalesce(1).write.mode("append").parquet(path)

    def by_date(self, name: str, key: str, dates: Sequence[date | str], build: Callable[[list[date]], DataFrame]) -> DataFrame:
        """The rows of the dates; ``build(missing dates)`` makes those that are not there.

        A date counts as done only after its rows are written, and rows of a date are replaced
        whole, so a run that was broken off adds nothing twice.
        """
        path, wanted = f"{self.folder}/{name}-{key}", sorted({to_date(d) for d in dates})
        done = set(self._dates(f"{path}/done"))
        missing = [d for d in wanted if d not in done]
        if missing:
            self.computed.append((name, missing))
            rows = build(missing)
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("as_of_date").parquet(f"{path}/rows")
            self._note(f"{path}/done", missing)
            columns = rows.schema
        else:
            columns = self.spark.read.parquet(f"{path}/rows").schema
        return self.spark.read.schema(columns).parquet(f"{path}/rows").where(F.col("as_of_date").isin(wanted))

    def features(self, key: str, cohort: DataFrame, source: DataFrame, spec: FeatureSource, dates: Sequence[date | str]) -> DataFrame:
        """Features of one source by date; dates after the kept states go on from them."""
        name = f"features-{spec.name}-{spec.prefix}"
        states = f"{self.folder}/{name}-{key}/states"

        def carried_before(day: date) -> Carried | None:
            kept = [d for d in self._dates(f"{states}/done") if d <= day]
            if not kept:
                return None
            parts = {k: self._read(f"{states}/{kept[-1]}/{k}") for k in ("values", "seen", "counts")}
            return Carried(kept[-1], **parts)

        def build(missing: list[date]) -> DataFrame:
            carried, last = carried_before(missing[0]), self._dates(f"{states}/done")
            if not last or missing[-1] > last[-1]:
                newest = carried_before(missing[-1])
                state = history_state(source, spec, missing[-1], newest)
                for part in ("values", "seen", "counts"):
                    if (df := getattr(state, part)) is not None:
                        df.write.mode("overwrite").parquet(f"{states}/{missing[-1]}/{part}")
                self._note(f"{states}/done", [missing[-1]])
            rows = cohort.where(F.col("as_of_date").isin(missing))
            return build_features(rows, source, spec, missing, carried=carried)

        return self.by_date(name, key, dates, build)
