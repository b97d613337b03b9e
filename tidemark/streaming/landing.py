"""The increment in streaming form, for batches that land as files.

Spark's checkpoint remembers which files were read, so no watermark is kept.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from tidemark.functions.audit import prepared
from tidemark.operators.lake import LakeTable


def load_landed_files(
    table: LakeTable, folder: str, schema: StructType | str, checkpoint: str, as_of: str
) -> None:
    """Upsert the files that arrived since the last call, then stop.

    ``checkpoint`` is a folder in shared storage. A micro-batch repeated after a
    failure leaves the same rows.
    """

    def merge(batch: DataFrame, number: int) -> None:
        table.upsert(prepared(batch, as_of, f"{table.short_name}_{number}"))

    query = (
        table.spark.readStream.schema(schema)
        .parquet(folder)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .queryName(f"{table.short_name}-{uuid.uuid4().hex[:8]}")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
