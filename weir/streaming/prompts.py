"""Generation over a growing table of prompts: the stream's checkpoint takes the place of the ledger scan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from weir.operators.generate import TextGenerator, respond


def stream_answers(spark: SparkSession, source: str, schema: str, prepare: Callable, factory: Callable[[], TextGenerator], sink: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Answers new rows of a Parquet folder; ``prepare`` maps a micro-batch to jobs (…, job_idx, messages).

    Each batch writes to a folder of its own number, so a batch that runs again replaces itself.
    """

    def step(df, epoch: int) -> None:
        respond(prepare(df), factory).write.mode("overwrite").parquet(f"{sink}/batch={epoch}")

    rows = spark.readStream.schema(schema).parquet(source)
    return rows.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
