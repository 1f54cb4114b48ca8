"""Session helpers: local sessions for tests/bench, checkpoint folder, lineage cuts."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Sequence
from contextlib import contextmanager, suppress

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def local_session(
    cores: int | str = "*",
    app: str = "tessera",
    shuffle_partitions: int = 8,
    driver_memory: str = "8g",
    extra: dict | None = None,
) -> SparkSession:
    """A local session configured the way the library expects (tests, bench).

    On a cluster, build the session yourself; the library only reads
    ``spark.checkpoint.dir`` from it.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Bytecode of a method that HotSpot still compiles, and Spark's own limit.
JIT_METHOD_BYTES = 8000
UNSET_METHOD_BYTES = "65535"


def wide_projection(spark: SparkSession) -> None:
    """Let projections of many expressions run as compiled code.

    Whole-stage code generation puts all expressions of a projection into one
    method; beyond 8000 bytes HotSpot leaves that method to the interpreter, for
    every row.  With the limit at HotSpot's own (as Spark's documentation says)
    such a stage uses projections split into small methods.  A limit that
    the session's owner has set stays.
    """
    if spark.conf.get("spark.sql.codegen.hugeMethodLimit", UNSET_METHOD_BYTES) == UNSET_METHOD_BYTES:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", str(JIT_METHOD_BYTES))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of the session.

    Order: a folder already set on the SparkContext, then the
    ``spark.checkpoint.dir`` setting of the session.  Only a local-mode session
    without either gets a fresh scratch folder (tests); a cluster session
    without a shared folder is an error, never a machine-local fallback.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:
            configured = None
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if sc.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="tessera-ckpt-", dir="/tmp")
        sc.setCheckpointDir(folder)
        return sc.getCheckpointDir() or folder
    raise RuntimeError(
        "spark.checkpoint.dir is not set: point it to a shared folder of the cluster"
    )


_scratch: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the session's shared checkpoint folder; it is
    deleted when the interpreter ends, or by :func:`release`."""
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def scratch_tables() -> list[str]:
    return list(_scratch)


def release(spark: SparkSession, paths: Sequence[str]) -> None:
    """Delete scratch folders.  Only for callers that have written what was read
    from them (a pipeline between stages, the session's end)."""
    gone = set(paths)
    for path in gone:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    _scratch[:] = [path for path in _scratch if path not in gone]


@atexit.register
def _release_at_exit() -> None:
    active = SparkSession.getActiveSession()
    with suppress(Exception):  # the JVM may be gone by then
        if active is not None:
            release(active, scratch_tables())


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the session's checkpoint folder.

    Used where a result must be computed exactly once (ranks that later stages
    join back on); a lost executor re-reads the files instead of recomputing.
    """
    ensure_checkpoint_dir(df.sparkSession)
    # an eager checkpoint evaluates the plan twice (count, then write);
    # persisting first makes both read the same blocks
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return cached.checkpoint(eager=True)
    finally:
        cached.unpersist()


def size_estimate(df: DataFrame) -> int:
    """The optimizer's estimate of the bytes of ``df``.

    Read from the plan's statistics: nothing runs, so shuffles upstream of
    ``df`` are not executed to learn a partition count.
    """
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def split_estimate(df: DataFrame) -> int:
    """Input splits that the size estimate amounts to (a million where the
    optimizer knows nothing)."""
    splits = -(-size_estimate(df) // df.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    return min(splits, 1 << 20)


def is_small(df: DataFrame) -> bool:
    """Whether the estimate is below one input split per core."""
    return split_estimate(df) <= df.sparkSession.sparkContext.defaultParallelism


def is_spread(df: DataFrame) -> bool:
    """Whether the plan already deals its rows to as many partitions as there
    are cores, by an explicit repartition in the plan itself or below a cached
    frame.  Nothing runs to find out."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    dealt = re.findall(r"\bRepartition (\d+), true|RepartitionByExpression \[.*\], (\d+)|(\d+)\), REPARTITION_BY_NUM", plan)
    cores = df.sparkSession.sparkContext.defaultParallelism
    return any(int(n) >= cores for found in dealt for n in found if n)


def spread(df: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """One partition per core for CPU-heavy stages over a small input.

    A large input already has many splits and is left alone (no shuffle); a
    small one (few files or row groups) is repartitioned so per-row work is
    not single-threaded: hashed on ``by`` (a unique key: balanced,
    deterministic without a sort) or round-robin.  One whose plan is spread
    already stays as it is.
    """
    if not is_small(df) or is_spread(df):
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *by) if by else df.repartition(cores)


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Persist a projection read by several jobs; always unpersist.

    Cached blocks are a speed-up only: a lost executor recomputes them
    from the (deterministic) lineage.
    """
    df = df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


@contextmanager
def staged(df: DataFrame, by: Sequence[str] | None = None):
    """Stage a whole-table input read by several jobs.

    A small input (see :func:`is_small`) is spread and persisted; a large one
    is yielded unchanged, so every job re-reads only the columns it
    needs from the (columnar) source instead of caching the whole table.
    """
    if not is_small(df):
        yield df
        return
    with persisted(spread(df, by)) as cached:
        yield cached
