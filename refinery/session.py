"""Session defaults and the shared folders the library writes to.

Nothing here hard-codes a machine-local path for cluster use: checkpoints and
scratch tables go under the directory the cluster names in
``spark.checkpoint.dir``.  Only a local-mode session without that setting gets
a private folder under the system temp directory, removed when the process
ends; on a cluster the missing setting is an error.
"""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark import InheritableThread
from pyspark.sql import DataFrame, SparkSession

# Settings a job of this library expects.  AQE re-plans joins from runtime
# sizes (broadcast when a side is small, sort-merge otherwise) and splits
# skewed sort-merge partitions; none of them is a hint on a table of unknown size.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", app: str = "refinery",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Session for tests, the bench and command-line runs."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Read from the running context first, then from ``spark.checkpoint.dir``.
    When both are unset a private folder is created, but only for a local-mode
    master: on a cluster a machine-local folder would not be visible to the
    other executors, so that case raises instead.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a Spark Connect session has no context: use the setting
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a folder shared by all executors")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="refinery-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory (never reused)."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/refinery-scratch/{name}-{uuid.uuid4().hex[:12]}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


_SCOPES: list[list[str]] = []


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Every scratch folder made inside (by any thread) is deleted at the end;
    frames that read one must be finished with by then."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            remove_folder(spark, path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to a fresh folder under the shared checkpoint
    directory and return a frame that reads it back.

    This cuts the lineage: later stages never recompute it, so
    nondeterministic columns computed before the write stay consistent, and
    a lost executor only costs a re-read.  Unlike ``DataFrame.checkpoint()``
    the result is columnar and carries real file sizes, so later
    scans read only the columns they use and the planner's size-based join
    choice (broadcast under ``spark.sql.autoBroadcastJoinThreshold``,
    sort-merge above it) is made on measured bytes."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    copy = spark.read.schema(df.schema).parquet(path)      # known schema: no footer-inference job
    copy.scratch_folder = path
    return copy


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it lies."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def move_folder(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder within its store; ``to`` must not exist yet."""
    jvm = spark.sparkContext._jvm
    source, target = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(to)
    store = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(target.getParent())
    if store.exists(target) or not store.rename(source, target):
        raise OSError(f"{path} could not be renamed to {to}")


def discard(*copies: DataFrame) -> None:
    """Delete what ``materialize`` wrote for these frames; call it once nothing
    that is still to be computed reads them.  The shuffle files of plans that
    are no longer in use go with it (``release_shuffles``)."""
    spark = None
    for df in copies:
        spark = df.sparkSession
        if folder := getattr(df, "scratch_folder", None):
            remove_folder(spark, folder)
    if spark is not None:
        release_shuffles(spark)


def release_shuffles(spark: SparkSession) -> None:
    """The driver collects its garbage, so that Spark's cleaner removes the
    shuffle files of plans that are no longer in use now, rather than at some
    later time."""
    spark.sparkContext._jvm.System.gc()


def concurrently(*calls: Callable[[], object]) -> list:
    """Run independent driver-side steps (each submitting its own Spark jobs)
    from separate threads, so their jobs are scheduled side by side instead
    of one after another; results come back in call order and the first
    failure is raised.  Useful when single jobs are too small to fill the
    cluster, e.g. building two dimensions or six silver tables.

    The threads are ``InheritableThread``s: they carry the caller's local
    properties (job group, description, scheduler pool), so cancelling the
    caller's job group also cancels the jobs started here."""
    if len(calls) <= 1:
        return [c() for c in calls]
    results: list = [None] * len(calls)
    errors: list = [None] * len(calls)

    def run(i: int, call: Callable[[], object]) -> None:
        try:
            results[i] = call()
        except BaseException as exc:  # noqa: BLE001 - re-raised in the caller's thread
            errors[i] = exc

    threads = [InheritableThread(target=run, args=(i, c)) for i, c in enumerate(calls)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    for e in errors:
        if e is not None:
            raise e
    return results
