"""Incremental gate: harvest files as they arrive, validate, split clean/quarantined.

The same row rules and split as the batch gate (R7), applied per micro-batch
with ``foreachBatch``: each batch is tagged once and written once, partitioned
by batch and status, and its rule summary is written next to it; re-running a
batch overwrites exactly its own partitions (idempotent sink).  Frame rules
(uniqueness) hold within a batch only; run them on the accumulated output.
Offsets and the sink commit log live under the shared checkpoint folder, so
a restarted query resumes without losing or duplicating batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from nestgate.functions.rules import FRAME, Rule
from nestgate.plans import validate as V
from nestgate.session import checkpoint_root


def json_document_stream(spark: SparkSession, path: str, schema: T.StructType,
                         max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming source of JSON-lines documents with a declared schema."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.json(path)


def write_batch(batch: DataFrame, batch_id: int, rules: Sequence[Rule], out_path: str, summary_path: str) -> None:
    """Tag, split and summarise one micro-batch.

    Idempotent: the batch owns the partition ``_batch=<id>`` (and
    ``batch_id=<id>`` of the summary), overwritten dynamically, so a batch
    re-run after a failure replaces its own output instead of appending it
    twice.  Two writes read the batch: it is persisted so the source is read once."""
    row_rules = [r for r in rules if r.level != FRAME]
    batch = batch.persist()
    try:
        tagged = (batch.withColumn("_failed_rules", V.failed_rules(row_rules))
                  .withColumn("_status", F.when(F.size("_failed_rules") == 0, "clean").otherwise("quarantined"))
                  .withColumn("_batch", F.lit(batch_id)))
        (tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("_batch", "_status").parquet(out_path))
        (V.summary(batch, row_rules).withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(summary_path))
    finally:
        batch.unpersist()


def start_gate(stream: DataFrame, rules: Sequence[Rule], out_path: str, summary_path: str,
               name: str = "nestgate_gate", available_now: bool = True) -> StreamingQuery:
    """Validate every micro-batch; rows land under ``out_path/_status=clean|quarantined``."""
    row_rules = [r for r in rules if r.level != FRAME]
    spark = stream.sparkSession
    ckpt = f"{checkpoint_root(spark)}/nestgate/stream-{name}"

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, row_rules, out_path, summary_path)

    writer = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", ckpt).queryName(name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
