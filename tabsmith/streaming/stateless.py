"""Run the stateless feature and scoring expressions on a stream.

Every feature operator (derive, indicators, constant fills, clamps, one-hot,
casts) and the batch scorer are per-row column expressions, so the same code
applies to ``spark.readStream`` DataFrames.  Statistics that need a pass over
data (medians, scaler statistics) must be fitted on a batch first and passed
in as constants.  The file sink with a checkpoint gives exactly-once output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tabsmith.session import output_path


def read_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None, glob: str | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def write_stream(df: DataFrame, spark: SparkSession, sink: str | None = None,
                 checkpoint: str | None = None, available_now: bool = True) -> tuple[StreamingQuery, str]:
    sink = sink or output_path(spark, "stream-sink")
    checkpoint = checkpoint or output_path(spark, "stream-ckpt")
    w = df.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start(sink), sink


def run_stream(spark: SparkSession, source: str, schema: StructType,
               transform: Callable[[DataFrame], DataFrame], timeout_s: int | None = None,
               glob: str | None = None) -> DataFrame:
    """Apply ``transform`` to the stream of files under the folder ``source``
    (optionally only names matching ``glob``) until all available input is
    processed, and return the sink as a table.  A limit, if one is given, stops
    the query and raises: a part of the output is never returned."""
    q, sink = write_stream(transform(read_stream(spark, source, schema, glob=glob)), spark)
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"the stream did not end within {timeout_s} s; its sink is incomplete")
    if q.exception() is not None:
        raise q.exception()
    return spark.read.parquet(sink)
