"""Tables written by runs, each of which counts whole or not at all.

A run writes its rows of every table into folders of its own and names them in
a manifest, one small file that is written last. Readers go by the manifests:
what a run left behind that failed at any step is never seen, and the same run,
or another one, can write it all again. So the rows of a run and its log always
tell of the same companies.
"""

from __future__ import annotations

from collections.abc import Mapping
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmscope.operators.lookup import pending
from firmscope.plans.enrich import YEARS, Landed, enrich_companies, outcomes, succeeded
from firmscope.sources import tables

MANIFEST = T.StructType([T.StructField(c, T.StringType()) for c in ("run", "name", "folder")])


class Runs:
    """The tables under ``base``."""

    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark, self.base = spark, base.rstrip("/")

    def _folder(self, run: str, name: str) -> str:
        return f"{self.base}/{name}/{quote(run, safe='')}"

    def _manifests(self) -> list[T.Row]:
        """One row per committed run and table, bounded by the number of runs."""
        try:
            return self.spark.read.schema(MANIFEST).parquet(f"{self.base}/_manifests/*").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def committed(self) -> set[str]:
        return {row.run for row in self._manifests()}

    def read(self, name: str) -> DataFrame | None:
        """The rows of all committed runs; None before the first."""
        folders = sorted(row.folder for row in self._manifests() if row.name == name)
        return self.spark.read.parquet(*(f"{self.base}/{folder}" for folder in folders)) if folders else None

    def write(self, run: str, name: str, rows: DataFrame) -> DataFrame:
        """Write a run's rows of a table, over what a failed try left there; not seen by ``read`` yet."""
        folder = self._folder(run, name)
        rows.write.mode("overwrite").parquet(folder)
        return self.spark.read.schema(rows.schema).parquet(folder)

    def commit(self, run: str, names: list[str]) -> None:
        """Let all of the run's tables be seen, by one file that is there or not."""
        folders = [(run, name, self._folder(run, name).removeprefix(f"{self.base}/")) for name in names]
        manifest = self.spark.createDataFrame(folders, MANIFEST).coalesce(1)
        manifest.write.mode("overwrite").parquet(f"{self.base}/_manifests/{quote(run, safe='')}")


def enrich_run(
    spark: SparkSession,
    source: str,
    base: str,
    landed: Landed,
    run: str,
    years: tuple[int, ...] = YEARS,
    gazetteers: tuple[DataFrame, DataFrame] | None = None,
    at: Column | None = None,
) -> Mapping[str, int]:
    """Enrich the companies of a file that no committed run has done yet.

    Under ``base`` stand the tables ``enriched`` and ``log`` (run, ts, id, ok).
    After a failure anywhere the run is tried again under the same name or
    another one: every company has one row in both tables. A name that is
    committed cannot be used again.
    """
    runs = Runs(spark, base)
    if run in runs.committed():
        raise ValueError(f"run {run!r} is committed already")
    companies = tables.read_companies(spark, source)
    done = runs.read("enriched")
    left = companies if done is None else pending(companies, done)
    written = runs.write(run, "enriched", enrich_companies(left, landed, years, gazetteers))
    log = outcomes(written, run, F.current_timestamp() if at is None else at, years)
    runs.write(run, "log", log)
    counts = written.agg(
        F.count(F.lit(1)).alias("processed"),
        F.count_if(succeeded(years)).alias("successful"),
        F.count_if(~succeeded(years)).alias("failed"),
    ).first()
    runs.commit(run, ["enriched", "log"])
    return counts.asDict()
