"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# What every job here relies on. Join strategy, skew splitting and partition
# counts are left to adaptive execution.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


STAGED: dict[str, list[str]] = {}  # folders written by each application
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
PARTITION_BYTES = 128 << 20  # of a shuffle partition before adaptive execution merges any


def shuffle_settings(input_bytes: int) -> dict[str, str]:
    """Shuffle width for jobs over ``input_bytes``: one partition per 128 MB, 200 at least.

    Adaptive execution merges partitions that turn out small, but does not cut even ones
    that are too large, so the width has to start from the input.
    """
    width = str(max(200, -(-input_bytes // PARTITION_BYTES)))
    return {"spark.sql.shuffle.partitions": width, "spark.sql.adaptive.coalescePartitions.initialPartitionNum": width}


def build_session(
    app: str = "mattercat", master: str | None = None, input_bytes: int | None = None, **extra: str
) -> SparkSession:
    """A session with the settings above; on a cluster leave ``master`` unset.

    ``input_bytes`` is the size of what the session's jobs read; it sets the width of shuffles.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    sized = shuffle_settings(input_bytes) if input_bytes else {}
    for key, value in {**SETTINGS, **sized, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; a
    cluster must name one, since executors do not share a machine's ``/tmp``.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="mattercat-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/mattercat/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str, by: str | None = None, **options) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where one costly result feeds several outputs: it is computed once and
    does not depend on executors staying alive. The files stay until the session ends
    (``scratch`` and ``drop_staged`` take them away earlier); ``options`` go to the writer. Shuffle
    files of the job go as soon as its result is written, since nothing reads them again. With ``by``
    each value of that column has a folder, so that a filter on it reads its own files only.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    with setting(spark, CLEANUP, "true"):
        df.write.options(**options).partitionBy(*[by] if by else []).parquet(path)
    STAGED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_folders(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders of staged results and forget them."""
    known = STAGED.get(spark.sparkContext.applicationId, [])
    for path in paths:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
        if path in known:
            known.remove(path)


def drop_staged(spark: SparkSession) -> None:
    """Delete what ``staged`` has written in this application; results built on it can't be read again."""
    delete_folders(spark, list(STAGED.get(spark.sparkContext.applicationId, [])))


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the length of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """What is staged inside is deleted at the end, but for results written by the function given.

    ``with scratch(spark) as keep: result = keep(build(), "label")`` runs ``build`` with all its
    intermediate tables, writes its result, and leaves only that. Nothing that is
    still to be computed may depend on the other tables. If the block fails, its tables stay until
    ``drop_staged``.
    """
    known = STAGED.setdefault(spark.sparkContext.applicationId, [])
    before, kept = set(known), []

    def keep(df: DataFrame, label: str) -> DataFrame:
        result = staged(df, label)
        kept.append(known[-1])
        return result

    yield keep
    delete_folders(spark, [p for p in known if p not in before and p not in kept])
