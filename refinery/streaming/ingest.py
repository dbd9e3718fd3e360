"""Incremental form of the bronze/silver load with Structured Streaming.

The batch load re-reads every landing file on each run.  Run as a stream
with an ``availableNow`` trigger, the same typed CSV read and the same
silver cleaning (map-only Column rules, so they apply to a streaming frame
unchanged) process only files that arrived since the last run; the file
sink and the checkpoint make each file land exactly once, and a run that
loses executors resumes from the checkpoint.  No state is kept across
micro-batches: cleaning is row-local.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from refinery.sources.files import header_order
from refinery.sources.schemas import SourceSpec


def stream_extract(spark: SparkSession, spec: SourceSpec, landing_root: str,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming frame over one extract's landing folder (typed, headered
    CSV, columns by header name; a file with another header or a value that
    does not fit its type fails the stream)."""
    path = f"{landing_root.rstrip('/')}/{spec.path}"
    fields = header_order(spark, path, spec.schema)
    reader = spark.readStream.schema(StructType(fields)).options(header="true", enforceSchema="false", mode="FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(path).select([F.col(f.name).alias(f.name) for f in spec.schema.fields])


def start_incremental(spark: SparkSession, spec: SourceSpec, landing_root: str, target: str,
                      checkpoint: str, clean: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Process every landing file not yet seen into Parquet at ``target``,
    optionally through a silver cleaning job, then stop."""
    df = stream_extract(spark, spec, landing_root)
    if clean is not None:
        df = clean(df)
    return (df.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start(target))


def finish(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait until the stream has ended.  One that does not within ``timeout_s``
    is stopped and raises: its target is incomplete."""
    ended = query.awaitTermination(timeout_s) if timeout_s is not None else query.awaitTermination() or True
    if not ended:
        query.stop()
        raise TimeoutError(f"the stream did not finish within {timeout_s} s; its target is incomplete")
    if query.exception() is not None:
        raise query.exception()


def run_incremental(spark: SparkSession, spec: SourceSpec, landing_root: str, target: str, checkpoint: str,
                    clean: Callable[[DataFrame], DataFrame] | None = None,
                    timeout_s: float | None = None) -> DataFrame:
    """Run one ``availableNow`` pass to completion and return the target table."""
    finish(start_incremental(spark, spec, landing_root, target, checkpoint, clean), timeout_s)
    return spark.read.parquet(target)


def run_incremental_all(spark: SparkSession, landing_root: str, target_root: str,
                        as_of=None, timeout_s: float | None = None) -> dict[str, str]:
    """All six extracts, each through its silver job, into ``target_root/<silver
    table>`` (checkpoints alongside).  The six streams are independent and are
    started together; returns {silver table: folder}."""
    from refinery.plans.silver import SILVER_JOBS, silver_erp_customers
    from refinery.sources.schemas import SOURCE_BY_TABLE

    root = target_root.rstrip("/")
    queries = {}
    for target, (source, job) in SILVER_JOBS.items():
        clean = (lambda df, j=job: j(df, as_of)) if job is silver_erp_customers else job
        queries[target] = start_incremental(spark, SOURCE_BY_TABLE[source], landing_root, f"{root}/{target}",
                                            f"{root}/_checkpoints/{target}", clean)
    try:
        for q in queries.values():
            finish(q, timeout_s)
    finally:
        for q in queries.values():
            q.stop()
    return {t: f"{root}/{t}" for t in queries}
