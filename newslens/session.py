"""Session helpers: the shared folder, written intermediate tables, how text input is dealt out."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
TEXT_PARTITIONS = "newslens.text.partitions"
_local_folders: dict[str, str] = {}
_written: list[str] = []


def build_session(app: str = "newslens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs expect; the cluster's own settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder; on a
    cluster a missing setting is an error, since a machine-local folder would
    not survive the loss of its machine.
    """
    folder = spark.conf.get(_SETTING, None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError(f"set {_SETTING} to a folder all executors share")
    app = context.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="newslens-")
    return _local_folders[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/newslens/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Drop the tables that ``materialize`` writes inside the block when it ends.

    For jobs whose result is written, or collected, within the block; blocks may nest.
    """
    first = len(_written)
    try:
        yield
    finally:
        for path in _written[first:]:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        del _written[first:]


def materialize(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to the shared folder, in folders by the columns ``by``, and read it back.

    Cuts the lineage so that a lost executor costs a re-read rather than a
    recomputation, and gives the optimizer the true size, so that it broadcasts
    the table only when it really is small.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    _written.append(path)
    df.write.partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal out the rows of a text job, into as many partitions as the session asks for.

    ``newslens.text.partitions`` is for inputs stored in a few large pieces, whose text work
    would otherwise run in a few tasks. Unset, the reader's own splits are kept.
    """
    pieces = df.sparkSession.conf.get(TEXT_PARTITIONS, None)
    return df.repartition(int(pieces)) if pieces else df
