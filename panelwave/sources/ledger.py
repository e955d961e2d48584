"""Outputs of periods under a commit protocol: a period counts as done by a manifest row that is written last.

A run writes every output of a period into a folder of its own attempt. Rows and
fingerprint of an output are observed during that write. When all outputs of the
period are stored, their manifest rows are added in one file. A run that dies
before leaves an attempt that no row names: it is never read, and the period
comes back in the work list. So does one whose stored rows are fewer than its
manifest says, whose input has changed, or whose columns have.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from panelwave.operators.shape import null_safe_join
from panelwave.sources.manifest import fingerprint, fingerprint_columns, fingerprint_text

MANIFEST = (
    "period string, output string, input string, columns string, attempt string, rows long, fingerprint string, run long"
)
#: Periods that are written side by side.
AT_ONCE = 4


class PeriodStore:
    """Named outputs, each a function of the rows of one period, below ``root``."""

    def __init__(self, spark: SparkSession, root: str, outputs: Mapping[str, Callable[[DataFrame], DataFrame]]):
        self.spark, self.root, self.outputs = spark, root.rstrip("/"), dict(outputs)

    def manifest(self) -> DataFrame:
        """The latest committed row of each period and output."""
        try:
            rows = self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], MANIFEST)
        latest = rows.groupBy("period", "output").agg(F.max_by(F.struct("*"), "run").alias("last"))
        return latest.select("last.*")

    def complete(self) -> DataFrame:
        """The manifest with ``stored``, the rows found in the attempt it names, and ``complete``: they are as many."""
        known = self.manifest()
        found = [
            self._folder(name).groupBy("period", "attempt").agg(F.count(F.lit(1)).alias("stored")).withColumn("output", F.lit(name))
            for name in self.outputs
            if self._exists(name)
        ]
        if not found:
            return known.withColumn("stored", F.lit(0).cast("long")).withColumn("complete", F.col("rows") == 0)
        stored = reduce(DataFrame.unionByName, found)
        joined = known.join(stored, ["period", "attempt", "output"], "left").withColumn("stored", F.coalesce("stored", F.lit(0)))
        return joined.withColumn("complete", F.col("rows") == F.col("stored"))

    def worklist(
        self, inputs: DataFrame, columns: Sequence[str], *, force: bool = False, only: Sequence[str] | None = None
    ) -> DataFrame:
        """Input periods ``(period, fingerprint)`` to process; all (of ``only``) with ``force``."""
        wanted = inputs.where(F.col("period").isin(*only)) if only is not None else inputs
        if force:
            return wanted
        listed = F.lit(",".join(columns))
        done = self.complete().where(F.col("complete") & (F.col("columns") == listed) & F.col("output").isin(*self.outputs))
        whole = done.groupBy("period", F.col("input").alias("fingerprint")).agg(F.count_distinct("output").alias("outputs"))
        current = whole.where(F.col("outputs") == len(self.outputs)).select("period", "fingerprint")
        return wanted.join(current, ["period", "fingerprint"], "left_anti")

    def run(
        self, table: DataFrame, period: str, columns: Sequence[str], *, force: bool = False, only: Sequence[str] | None = None,
        before_commit: Callable[[str], None] | None = None,
    ) -> list[str]:
        """Processes the periods of the work list and returns them in order.

        A period that fails does not stop the others; the failures are raised
        together at the end. ``before_commit`` is called between the writes of
        a period and its commit. Rows of a NULL period are an error.
        """
        inputs = fingerprint(table, [period]).withColumnRenamed(period, "period")
        todo = sorted((r.period, r.fingerprint) for r in self.worklist(inputs, columns, force=force, only=only).collect())
        if any(p is None for p, _ in todo):
            raise ValueError("rows without a period")

        def one(item: tuple[str, str]) -> Exception | None:
            try:
                self._process(table.where(F.col(period) == item[0]).drop(period), *item, columns, before_commit)
            except Exception as e:  # reported below, with those of the other periods
                return e
            return None

        with ThreadPoolExecutor(AT_ONCE) as pool:
            failed = [e for e in pool.map(one, todo) if e is not None]
        if failed:
            raise ExceptionGroup(f"{len(failed)} of {len(todo)} periods failed", failed)
        return [p for p, _ in todo]

    def read(self, name: str) -> DataFrame:
        """The committed rows of one output, with ``period``; attempts that no manifest row names are not opened."""
        rows = self.manifest().where(F.col("output") == name).select("period", "attempt").collect()
        frame = self._folder(name)
        chosen = [f"(period = '{r.period}' AND attempt = '{r.attempt}')" for r in rows]
        return frame.where(" OR ".join(chosen) or "false").drop("attempt")

    def differences(self, name: str) -> DataFrame:
        """Periods whose stored rows do not have the fingerprint that was observed when they were written."""
        again = fingerprint(self.read(name), ["period"]).select("period", F.col("fingerprint").alias("found"))
        known = self.manifest().where(F.col("output") == name)
        return null_safe_join(known, again, ["period"], "left").where((F.col("rows") > 0) & ~F.col("found").eqNullSafe(F.col("fingerprint")))

    def _process(self, part: DataFrame, period: str, given: str, columns: Sequence[str], before_commit) -> None:
        attempt = uuid.uuid4().hex
        rows = []
        for name, step in self.outputs.items():
            out = step(part)
            seen = Observation(f"{name}-{attempt}")
            values = fingerprint_columns(out.withColumn("period", F.lit(period)))
            marks = [c.alias(n) for c, n in zip(values, ("rows", "xor", "total", "second"), strict=True)]
            # Every row has the period as a column, as it will have when it is read back.
            out.withColumn("period", F.lit(period)).observe(seen, *marks).drop("period").write.parquet(
                f"{self.root}/{name}/period={period}/attempt={attempt}"
            )
            found = seen.get
            mark = fingerprint_text(*(found[n] for n in ("rows", "xor", "total", "second")))
            rows.append((period, name, given, ",".join(columns), attempt, found["rows"], mark, time.time_ns()))
        if before_commit is not None:
            before_commit(period)
        # A folder for each commit: writers side by side must not share a staging folder.
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.parquet(f"{self.root}/manifest/commit={uuid.uuid4().hex}")

    def _folder(self, name: str) -> DataFrame:
        frame = self.spark.read.parquet(f"{self.root}/{name}")
        return frame.withColumn("period", F.col("period").cast("string"))

    def _exists(self, name: str) -> bool:
        try:
            self._folder(name)
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return False
        return True
