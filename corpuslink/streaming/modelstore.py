"""Character models that grow: stored counts of sample batches, summed when they are read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslink.operators import textmodel
from corpuslink.session import discard, list_folders

COMPACT_EVERY = 16


class ModelStore:
    """Gram counts of order ``k`` below ``folder``, one folder per batch number.

    A batch that comes again replaces its own folder, so a repeat is harmless. After every
    ``compact_every`` batches the sums so far are written as a base, which stands for all batches up
    to its number; those are not taken again and their folders go once the base is complete. A
    folder counts when Spark has marked its write as done. Batches are numbered upwards and one
    writer works on a folder at a time."""

    def __init__(self, spark: SparkSession, folder: str, k: int, compact_every: int = COMPACT_EVERY):
        textmodel._check_order(k)
        self.spark, self.folder, self.k, self.compact_every = spark, folder, k, compact_every

    def _complete(self, kind: str) -> list[int]:
        names = list_folders(self.spark, self.folder, done=True)
        return sorted(int(n.partition("=")[2]) for n in names if n.startswith(f"{kind}="))

    def base(self) -> int:
        """Number of the last batch in the newest base, -1 if there is none."""
        return max(self._complete("base"), default=-1)

    def add(self, samples: DataFrame, batch: int) -> None:
        """Fold ``(label, text)`` rows in under a batch number."""
        if batch <= self.base():
            return
        counts = textmodel.gram_counts(samples.where(F.col("label").isNotNull()), self.k)
        counts.write.mode("overwrite").parquet(f"{self.folder}/batch={batch}")
        if (batch + 1) % self.compact_every == 0:
            self.compact()

    def compact(self) -> None:
        """Write the sums of all batches so far as the new base."""
        base, batches = self.base(), [b for b in self._complete("batch")]
        if not batches or batches[-1] <= base:
            return
        self.gram_counts().write.mode("overwrite").parquet(f"{self.folder}/base={batches[-1]}")
        for old in batches:
            discard(self.spark, f"{self.folder}/batch={old}")
        if base >= 0:
            discard(self.spark, f"{self.folder}/base={base}")

    def gram_counts(self) -> DataFrame:
        """``(label, gram, n)`` of all samples so far."""
        base = self.base()
        paths = [f"{self.folder}/batch={b}" for b in self._complete("batch") if b > base]
        paths += [f"{self.folder}/base={base}"] if base >= 0 else []
        if not paths:
            return self.spark.createDataFrame([], "label string, gram string, n bigint")
        # Each folder is read by itself: its name is no column.
        parts = [self.spark.read.schema("label string, gram string, n bigint").parquet(p) for p in paths]
        every = parts[0]
        for part in parts[1:]:
            every = every.unionByName(part)
        return every.groupBy("label", "gram").agg(F.sum("n").alias("n"))

    def model(self, labels: Sequence[str]) -> textmodel.TextModel:
        """The model of all samples so far."""
        grams = self.gram_counts().where(F.col("label").isin(list(labels)))
        return textmodel.TextModel(
            self.k, tuple(labels), grams, textmodel.context_counts(grams, self.k), textmodel.alphabet_sizes(grams)
        )

    def follow(self, stream: DataFrame) -> None:
        """Fold in what a stream of ``(label, text)`` rows holds now. Started again with the same
        folder, it goes on where it stopped; a batch cut off half-way comes again under its number."""
        query = (
            stream.writeStream.foreachBatch(self.add)
            .option("checkpointLocation", f"{self.folder}/offsets")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
