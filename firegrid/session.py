"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


# Temporary folders of local-mode sessions without a configured one, by application id.
_LOCAL_DIRS: dict[str, str] = {}


def get_session(app: str = "firegrid", master: str | None = None) -> SparkSession:
    """A session with the settings the library relies on (AQE, UTC).

    Shuffle partitions are left to AQE: a high initial number is coalesced at run time, so the
    same settings serve a laptop and a cluster.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local-mode session may fall back on a
    folder of its own; on a cluster a missing setting is an error, because executors could not see
    a machine-local folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="firegrid-")
    return _LOCAL_DIRS[app]


def run_dir(spark: SparkSession) -> str:
    """This session's own part of the shared folder."""
    return f"{scratch_dir(spark)}/firegrid-{spark.sparkContext.applicationId}"


# Folders of the scopes that are open, innermost last.
_SCOPES: ContextVar[tuple[str, ...]] = ContextVar("scopes", default=())


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables stored inside the ``with`` block are deleted when it ends.

    Only for blocks whose results are written elsewhere: DataFrames built on those tables become unreadable.
    """
    path = f"{run_dir(spark)}/scope-{uuid.uuid4().hex}"
    token = _SCOPES.set((*_SCOPES.get(), path))
    try:
        yield
    finally:
        _SCOPES.reset(token)
        _delete(spark, path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this session.  DataFrames built on them become unreadable."""
    _delete(spark, run_dir(spark))


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    Survives the loss of executors, costs one pass (``checkpoint()`` computes an unpersisted plan
    twice), keeps column pruning, and gives the planner real sizes for the next join.
    """
    spark = df.sparkSession
    path = f"{(_SCOPES.get() or (run_dir(spark),))[-1]}/t-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_counted(df: DataFrame) -> tuple[DataFrame, int]:
    """``cut`` plus the number of rows written, counted on the way without another job."""
    seen = Observation()
    out = cut(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return out, observed(seen, out)


def observed(seen: Observation, written: DataFrame) -> int:
    """The rows counted by ``seen`` (as ``n``) when ``written`` was stored.

    The planner drops the counter together with a plan it knows to be empty; then the file footers tell.
    """
    try:
        return seen.get["n"]
    except (Py4JJavaError, AssertionError, KeyError):
        return written.count()
