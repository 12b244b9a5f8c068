"""Batch scoring on a stream: every micro-batch through the saved scorer into the
run-stamped sink, once however often it is replayed."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tabsmith.plans.scoring import BatchScorer
from tabsmith.session import output_path
from tabsmith.sources import io


def batch_writer(scorer: BatchScorer, run: str, id_col: str | None = None,
                 keep: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """What ``foreachBatch`` calls: scores a batch and writes it under its id."""
    def write(batch: DataFrame, batch_id: int) -> None:
        io.write_batch(scorer.score(batch, id_col, keep), run, batch_id)

    return write


def score_stream(stream: DataFrame, scorer_path: str, folder: str, checkpoint: str | None = None, run: str | None = None,
                 id_col: str | None = None, keep: Sequence[str] = (), available_now: bool = True) -> tuple[StreamingQuery, str]:
    """Starts scoring a stream; returns the query and the folder of the run.  To go on
    with a run after a failure give its ``run`` and ``checkpoint`` again: the batch
    that was under way replaces what it had written."""
    spark = stream.sparkSession
    run = run or io.run_folder(folder)
    writer = stream.writeStream.foreachBatch(batch_writer(BatchScorer.load(spark, scorer_path), run, id_col, keep))
    writer = writer.option("checkpointLocation", checkpoint or output_path(spark, "score-ckpt"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start(), run


def score_available(stream: DataFrame, scorer_path: str, folder: str, **options) -> DataFrame:
    """All that the stream has now, scored, as a table."""
    spark: SparkSession = stream.sparkSession
    query, run = score_stream(stream, scorer_path, folder, **options)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return io.read_table(spark, run).drop("batch_id")
