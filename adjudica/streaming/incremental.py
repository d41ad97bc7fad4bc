"""Queues that keep arriving: each micro-batch runs the batch job and adds only what is new."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from adjudica.operators.outbox import new_rows, publish_batch, read_state, state_for
from adjudica.session import stage

Job = Callable[[DataFrame], Mapping[str, DataFrame]]


def run_incremental(
    stream: DataFrame, job: Job, root: str, checkpoint: str, tables: Mapping[str, tuple[list[str], list[str], str]]
) -> None:
    """Drain what has arrived through ``job`` into the state tables under ``root``.

    ``tables`` maps a name to (key columns, order columns, schema). A batch that is replayed after a
    failure finds its own rows published and adds nothing, so nothing is lost or written twice. It opens only those
    stored rows that may share its keys.
    """

    def one_batch(batch: DataFrame, number: int) -> None:
        label = f"b{number:09d}"
        frames = {}
        for name, df in job(batch).items():
            keys, order, schema = tables[name]
            # Written once: the key filters, the comparison and the publication read it.
            df = stage(df, name)
            frames[name] = new_rows(df, state_for(df, root, name, schema, keys, label), keys, order)
        publish_batch(frames, root, label, {name: keys for name, (keys, _, _) in tables.items()})

    query = (
        stream.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def distinct_events(
    stream: DataFrame, keys: list[str], order: list[str], root: str, checkpoint: str, name: str = "events"
) -> DataFrame:
    """Drain a stream and return the first row per key of all that ever arrived, however late it came.

    Keys are compared with what earlier batches stored under ``root``; there is no lateness bound.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema)
    run_incremental(stream, lambda batch: {name: batch}, root, checkpoint, {name: (keys, order, schema)})
    return read_state(stream.sparkSession, root, name, schema)


def read_folder(spark: SparkSession, path: str, schema: str, per_batch: int = 1000) -> DataFrame:
    """Parquet files landing in a folder, as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(path)
