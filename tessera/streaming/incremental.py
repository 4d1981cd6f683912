"""Incremental runs over a landing folder: each new batch of payload files is one run."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans.profile import Profile
from tessera.plans.run import Summary, run
from tessera.sources.payloads import payloads_of


def run_new_files(spark: SparkSession, landing: str, root: str, checkpoint: str, boards: dict[str, dict[str, str]] | None = None, profile: Profile | None = None, provider_mode: str | None = None, now: datetime | None = None) -> list[Summary]:
    """Processes the files that no earlier call has seen, and ends. Loads are idempotent, so that a batch that is played again does no harm."""
    done: list[Summary] = []

    def one(batch: DataFrame, _id: int) -> None:
        done.append(run(batch.sparkSession, payloads_of(batch, boards or {}), root, profile, now or datetime.now(UTC).replace(tzinfo=None), "stream", provider_mode))

    files = spark.readStream.format("text").option("wholetext", "true").load(f"{landing.rstrip('/')}/*/").select(F.col("value").alias("raw"), F.col("_metadata.file_path").alias("path"))
    stream = files.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    stream.awaitTermination()
    return done
