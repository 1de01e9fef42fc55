"""Session settings and the shared folder for tables written along the way."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# The folder of the run that is going on in this thread, if there is one.
_run: ContextVar[str | None] = ContextVar("run", default=None)


def local_session(app: str, cores: int | str = "*", shuffle_partitions: int = 8, scratch: str | None = None) -> SparkSession:
    """A single-machine session for tests and benches; on a cluster pass your own session.

    ``scratch`` is the folder for tables written along the way; without one
    they go below the system's temporary folder, which is right for a single
    machine only.
    """
    session = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    if scratch is not None:
        session.sparkContext.setCheckpointDir(scratch)
    return with_scratch(session)


def with_scratch(spark: SparkSession) -> SparkSession:
    """``spark``, with a folder of its own if it runs on this machine alone and names none.

    A session on a cluster is left as it is: it has to name a folder that all
    executors share.
    """
    context = spark.sparkContext
    alone = context.master == "local" or context.master.startswith("local[")
    if alone and context.getCheckpointDir() is None and spark.conf.get("spark.checkpoint.dir", None) is None:
        import tempfile

        context.setCheckpointDir(tempfile.mkdtemp(prefix="newsloom-"))
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; without one this is an error."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, in the run's folder during a run."""
    return f"{_run.get() or scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_run(spark: SparkSession, label: str = "run") -> Iterator[str]:
    """A folder for everything written along the way inside the block, removed at its end.

    For work whose results are written elsewhere before the block ends. A run
    inside a run uses the outer one's folder.
    """
    from newsloom.sources.files import remove

    if _run.get() is not None:
        yield _run.get()
        return
    folder = scratch_path(spark, label)
    token = _run.set(folder)
    try:
        yield folder
    finally:
        _run.reset(token)
        remove(spark, folder)


def spool(df: DataFrame, label: str = "spool") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage so that the work is done once and a lost executor costs a
    re-read only, and gives the planner the real size of the result.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
