"""Starting streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from millrace.streaming.sinks import Sink

# Where operators with state and timers of their own keep it.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"

# Rows a console sink shows of each batch.
CONSOLE_ROWS = 10


def run_stream(
    df: DataFrame,
    sink: Sink | str,
    checkpoint: str,
    *,
    trigger: str | None = None,
    mode: str = "append",
    name: str | None = None,
    options: dict[str, str] | None = None,
    state_store: str | None = None,
) -> StreamingQuery:
    """Start a query that goes on from ``checkpoint``.

    ``sink`` is a function of (batch, batch_id) or the name of a built-in format:
    ``console``, ``noop``, ``parquet`` and so on. ``trigger`` is a batch interval
    such as ``'2 seconds'``, ``'available'`` to take what is there and stop, or
    None for one batch after the other. ``state_store`` is the provider of this query's
    state alone; the operators of ``streaming.state`` need ``ROCKSDB``.
    """
    if not checkpoint:
        raise ValueError("a stream needs a checkpoint folder to restart from")
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if trigger == "available":
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    if callable(sink):
        writer = writer.foreachBatch(sink)
    else:
        writer = writer.format(sink)
        if sink == "console":
            writer = writer.option("numRows", CONSOLE_ROWS).option("truncate", "false")
    writer = writer.options(**(options or {}))
    if state_store is None:
        return writer.start()
    # A query takes its settings when it starts, and keeps them.
    conf = df.sparkSession.conf
    usual = conf.get(_PROVIDER, None)
    conf.set(_PROVIDER, state_store)
    try:
        return writer.start()
    finally:
        conf.set(_PROVIDER, usual) if usual is not None else conf.unset(_PROVIDER)


def run_to_end(df: DataFrame, sink: Sink | str, checkpoint: str, **kwargs) -> StreamingQuery:
    """``run_stream`` over the data there is, until it is done; errors are raised."""
    query = run_stream(df, sink, checkpoint, trigger="available", **kwargs)
    query.awaitTermination()
    return query
