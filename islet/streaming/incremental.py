"""Counts tables that arrive as files: kept up to date by a file stream, and cohort statistics that grow batch by batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from islet.functions.numeric import null_if_nan, same_rows
from islet.functions.storage import keep
from islet.operators.cohort import LOCUS
from islet.sources.tables import COUNTS


def counts_stream(spark: SparkSession, path: str, *, files_per_batch: int = 100) -> DataFrame:
    """New counts files of a folder, as they land."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).csv(path, sep="\t", header=True, schema=COUNTS)


def append_counts(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Appends each batch to a table by sample, without repeats in the batch; ends when the folder is read. A batch that runs again writes its own folder again."""

    def write(batch: DataFrame, number: int) -> None:
        batch.dropDuplicates(["sample", "island_id", "haplotype"]).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class CohortStates:
    """Statistics of each locus that a batch of counts adds to, instead of a run over all counts again.

    A locus's state is how many samples have each value (whole ten-thousandths, so at most 10,001, or none): numbers, means, deviations and exact
    quartiles all follow from it, and states of batches add up. A batch is a folder of such rows beside the rows' keys; it
    reads the keys that came before, and a (sample, locus) that came already, in the batch or before, is refused: it doesn't count again (in a batch its
    least value counts), and ``add`` tells how many did.
    Folders are named by the batch's number, so that a batch that runs again replaces itself. ``compact`` adds up all states so far.
    """

    def __init__(self, spark: SparkSession, path: str, *, keys: Sequence[str] = LOCUS, sample: str = "sample", value: str = "frac_meth"):
        self.spark, self.path, self.keys, self.sample, self.value = spark, path.rstrip("/"), list(keys), sample, value

    def _read(self, kind: str, before: int | None = None) -> DataFrame | None:
        """The rows of a kind: the last compacted state and the batches behind it, or of batches before one alone."""
        try:
            rows = self.spark.read.parquet(f"{self.path}/{kind}/*").withColumn("_batch", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise
        return rows if before is None else rows.where(F.col("_batch") < f"{before:012d}")

    def add(self, batch: DataFrame, number: int) -> int:
        """Adds a batch; gives the number of rows that were refused as repeats."""
        at = [self.sample, *self.keys]
        rows = keep(batch.select(*at, F.round(null_if_nan(F.col(self.value)) * 1e4).cast("long").alias("f")))
        once = rows.groupBy(*at).agg(F.min("f").alias("f"))
        seen = self._read("seen", number)
        # by a merge: a small file of keys holds many rows, which a broadcast would send through the driver
        fresh = once if seen is None else once.alias("a").join(seen.hint("merge").alias("b"), same_rows("a", "b", at), "left_anti")
        fresh.write.mode("overwrite").parquet(f"{self.path}/seen/{number:012d}")
        mine = self.spark.read.schema(fresh.schema).parquet(f"{self.path}/seen/{number:012d}")
        mine.groupBy(*self.keys, "f").agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{self.path}/states/{number:012d}")
        return rows.count() - mine.count()

    def states(self) -> DataFrame | None:
        """(keys, f, n): how many samples have each value, over all batches."""
        rows, base = self._read("states"), self._read("compacted")
        if base is not None:
            upto = base.agg(F.max("_batch")).scalar()
            rows = base.where(F.col("_batch") == upto).unionByName(rows.where(F.col("_batch") > upto))
        return None if rows is None else rows.groupBy(*self.keys, "f").agg(F.sum("n").alias("n"))

    def compact(self, number: int) -> None:
        """Adds up the states of all batches up to the last one, ``number``; later reads begin there."""
        self.states().write.mode("overwrite").parquet(f"{self.path}/compacted/{number:012d}")

    def stats(self, *, min_samples: int = 5) -> DataFrame | None:
        """``cohort.locus_stats`` of all batches, without attributes."""
        states = self.states()
        if states is None:
            return None
        some, f, x = F.col("f").isNotNull(), F.col("f"), F.col("f") / 1e4
        n, s, q = F.sum(F.when(some, F.col("n"))), F.sum(f * F.col("n")), F.sum(f * f * F.col("n"))
        var = F.try_divide(q.cast("double") - s.cast("double") * s.cast("double") / F.nullif(n, F.lit(0)), (n - 1).cast("double")) / 1e8
        quartiles = F.percentile(F.when(some, x), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("n"))
        made = states.groupBy(*self.keys).agg(F.sum("n").alias("cohort_n_samples"), (F.try_divide(s.cast("double"), n.cast("double")) / 1e4).alias("mean"), F.sqrt(F.when(n > 1, F.greatest(var, F.lit(0.0)))).alias("std"), quartiles.alias("q"), F.min(x).alias("cohort_min"), F.max(x).alias("cohort_max"))
        enough = lambda c: F.when(F.col("cohort_n_samples") >= min_samples, c)
        q25, q50, q75 = (F.get("q", F.lit(i)) for i in range(3))
        return made.select(*self.keys, "cohort_n_samples", enough(F.col("mean")).alias("cohort_mean"), enough(F.col("std")).alias("cohort_std"), enough(q50).alias("cohort_median"), enough(q25).alias("cohort_q25"), enough(q75).alias("cohort_q75"), "cohort_min", "cohort_max", enough(q75 - q25).alias("cohort_IQR"))


def cohort_stream(stream: DataFrame, states: CohortStates, checkpoint: str) -> StreamingQuery:
    """Adds each batch of a counts stream to the states; ends when the folder is read."""

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        states.add(batch, number)
        batch.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
