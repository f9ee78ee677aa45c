"""A keyed table kept up by small batches: hash buckets, versions, one commit per batch.

Rows lie in ``data/epoch=N/bucket=K``.  A batch is merged with the stored rows
of the buckets that its keys fall in, and only those buckets are written, into
the batch's own epoch folder.  ``manifest/epoch=N`` then names the epoch that
holds each bucket; it is one file that appears by a rename, and it is the
commit: readers use the newest manifest, so they never see half a batch, and a
batch that is run again replaces its own folder and nothing that is in use.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.lineage import materialize

BUCKET = "bucket"


@dataclass(frozen=True)
class BucketTable:
    """``merge`` reduces rows to those that stay, for any set of rows that holds all rows of a key.

    ``buckets`` bounds what the driver handles of a batch (one number per
    bucket); choose it so that a bucket is a few hundred megabytes.
    """

    path: str
    keys: Sequence[str]
    merge: Callable[[DataFrame], DataFrame]
    buckets: int = 32

    def versions(self, spark: SparkSession, before: int | None = None) -> dict[int, int]:
        """The epoch that holds each bucket, by the newest manifest (of an epoch less than ``before``)."""
        try:
            manifest = spark.read.parquet(f"{self.path}/manifest")
        except AnalysisException:  # nothing was committed yet
            return {}
        if before is not None:
            manifest = manifest.where(F.col("epoch") < before)
        newest = manifest.agg(F.max("epoch")).first()[0]
        if newest is None:
            return {}
        return {r[BUCKET]: r["held"] for r in manifest.where(F.col("epoch") == newest).collect()}

    def _stored(self, spark: SparkSession, versions: dict[int, int]) -> DataFrame:
        folders = [f"{self.path}/data/epoch={epoch}/{BUCKET}={k}" for k, epoch in sorted(versions.items())]
        return spark.read.parquet(*folders)

    def upsert(self, batch: DataFrame, epoch: int) -> None:
        """Merge a batch; made to be a ``foreachBatch`` writer."""
        spark = batch.sparkSession
        bucket = F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(self.buckets)).cast("int")
        fresh = materialize(batch.withColumn(BUCKET, bucket), "batch")
        touched = sorted(r[0] for r in fresh.select(BUCKET).distinct().collect())
        versions = self.versions(spark, before=epoch)
        held = {k: versions[k] for k in touched if k in versions}
        rows = fresh.drop(BUCKET)
        if held:
            rows = rows.unionByName(self._stored(spark, held).select(*rows.columns))
        if touched:
            merged = self.merge(rows).withColumn(BUCKET, bucket)
            # buckets are balanced, being hashes of whole keys: one task and one file each
            merged = merged.repartition(len(touched), BUCKET)
            merged.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/data/epoch={epoch}")
        versions |= dict.fromkeys(touched, epoch)
        listed = spark.createDataFrame(sorted(versions.items()), f"{BUCKET} int, held long")
        listed.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/epoch={epoch}")

    def read(self, spark: SparkSession) -> DataFrame:
        """The rows of the last committed batch; an error where there is none yet."""
        versions = self.versions(spark)
        if not versions:
            raise FileNotFoundError(f"no committed rows under {self.path}")
        return self._stored(spark, versions)
