"""Demultiplex read chunks once each, as their files arrive.

Chunks already processed are skipped by the stream's checkpoint. UMI evidence is
defined within one read chunk, so a batch of whole chunks needs no state from
earlier batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.demux import demux
from ..sinks.tables import prefix_layout

READ_SCHEMA = (
    "chunk_id string, rid bigint, r1_header string, r1_seq string, r1_qual string, "
    "r2_header string, r2_seq string, r2_qual string"
)


def demux_new_chunks(
    spark: SparkSession, source: str, whitelist: DataFrame, output: str, checkpoint: str, *, prefix_bases: int = 0
) -> StreamingQuery:
    """Process the Parquet read chunks under ``source`` that no earlier run has seen, then stop.

    Every batch overwrites its own folders ``output/{valid,evidence,funnel}/batch=N``,
    so a batch repeated after a failure leaves one copy.
    """

    def write(batch: DataFrame, number: int) -> None:
        result = demux(batch, whitelist)
        tables = {
            "valid": prefix_layout(result.valid, prefix_bases),
            "evidence": result.evidence,
            "funnel": result.funnel,
        }
        for name, table in tables.items():
            table.write.mode("overwrite").parquet(f"{output}/{name}/batch={number}")

    return (
        spark.readStream.schema(READ_SCHEMA)
        .parquet(source)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
