"""Structured Streaming: fetch metrics by event time, retry state by target, an exactly-once sink."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

METRICS = "window_start timestamp, domain string, n_attempts long, n_success long, mean_seconds double"


def fetch_metrics(log: DataFrame, width: str = "1 hour", late: str = "2 days") -> DataFrame:
    """Attempts, successes and mean seconds by window of ``finished_at`` and domain.

    On a stream a watermark of ``late`` bounds the state; repeats within it count once. A
    batch table gives the same rows at once.
    """
    rows = log.withWatermark("finished_at", late) if log.isStreaming else log
    key = ["fetch_key", "attempt", "finished_at"]
    rows = rows.dropDuplicatesWithinWatermark(key) if log.isStreaming else rows.dropDuplicates(key)
    g = rows.groupBy(F.window("finished_at", width).alias("w"), "domain")
    agg = g.agg(F.count(F.lit(1)).alias("n_attempts"), F.sum((F.col("status") == "SUCCESS").cast("long")).alias("n_success"), F.avg("elapsed_seconds").alias("mean_seconds"))
    return agg.select(F.col("w.start").alias("window_start"), "domain", "n_attempts", "n_success", "mean_seconds")


STATE = "attempts int, status string"
OUTCOMES = "fetch_key string, attempts int, status string, next_retry_at double"


def retry_state(outcomes: DataFrame, max_attempts: int = 3, base: float = 30.0, forget: float = 86_400.0, late: str = "1 hour") -> DataFrame:
    """Per target the state after each batch of outcomes ``(fetch_key, attempt, status, retryable, at)``; ``at`` is in seconds.

    Outcomes that come after a target's end are ignored. Once the watermark, ``late`` behind the
    newest ``at``, has passed the end by ``forget`` seconds the target leaves the state, which so holds
    open targets and recent ends only.
    """

    def run(key: tuple[str], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        attempts, status = state.get if state.exists else (0, "PENDING")
        wait, newest = None, 0.0
        for pdf in batches:
            for r in pdf.sort_values(["attempt", "at", "status"]).itertuples():
                newest = max(newest, float(r.at))
                if status not in ("PENDING", "RETRY_WAIT"):
                    break
                attempts = max(attempts + 1, int(r.attempt))
                if bool(r.retryable) and attempts < max_attempts and r.status != "SUCCESS":
                    status, wait = "RETRY_WAIT", float(r.at) + base * 2 ** (attempts - 1)
                else:
                    status, wait = r.status, None
        state.update((attempts, status))
        if status not in ("PENDING", "RETRY_WAIT"):
            state.setTimeoutTimestamp(max(state.getCurrentWatermarkMs() + 1, int((newest + forget) * 1000)))
        yield pd.DataFrame({"fetch_key": [key[0]], "attempts": [attempts], "status": [status], "next_retry_at": [wait]})

    timed = outcomes.withColumn("happened_at", F.timestamp_seconds("at")).withWatermark("happened_at", late)
    return timed.groupBy("fetch_key").applyInPandasWithState(run, OUTCOMES, STATE, "update", GroupStateTimeout.EventTimeTimeout)


def pipeline(tasks: DataFrame, extract, path: str, checkpoint: str, per_batch: int | None = None, seconds: float | None = None) -> StreamingQuery:
    """A bounded continuous pipeline: a stream of tasks, ``extract`` on each micro-batch, an exactly-once sink.

    The source's rate bounds what is under way (``maxFilesPerTrigger`` and the like), each micro-batch
    is flushed before its offsets are, and a run that stops after ``seconds`` is taken up where it
    ended from ``checkpoint``. ``per_batch`` is the most rows a file of the sink holds.
    """

    def put(batch: DataFrame, number: int) -> None:
        out = extract(batch).write.mode("overwrite")
        (out.option("maxRecordsPerFile", per_batch) if per_batch else out).parquet(f"{path}/batch={number}")

    run = tasks.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if seconds is not None and not run.awaitTermination(seconds):
        run.stop()  # what was not committed is read again by the next run
    return run


def write_batches(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Exactly-once Parquet: each micro-batch overwrites its own folder, so a replay changes nothing."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return rows.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
