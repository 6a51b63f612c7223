"""Intermediate results of iterative jobs, kept where every executor can read them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


_ROOTS: dict[str, list[str]] = {}  # folders made by the session of an application, until removed


def _local_only(spark: SparkSession, root: str) -> bool:
    """Whether a path without a scheme, or with ``file:``, is on the disk of each machine."""
    scheme = root.split(":/", 1)[0] if ":/" in root else None
    if scheme is None:
        context = spark.sparkContext
        default = context._jvm.org.apache.hadoop.fs.FileSystem.getDefaultUri(
            context._jsc.hadoopConfiguration()
        )
        scheme = default.getScheme()
    return scheme in (None, "file")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    On a cluster a setting without a scheme, where the default file system is the local disk, counts if the
    application was started with it: Spark has then made a folder of its own in it, and that one is used,
    by its full name. Whoever starts an application with the setting says that all nodes share it. Where Spark
    has made none, the setting is refused unless the master is ``local`` or ``local[...]``.

    A session without the setting uses a folder in its warehouse, if that is on a file system which
    all executors share: a warehouse on local disks (``file:``, Spark's default) is refused unless all
    executors are on the driver's machine, as those of ``local``, ``local[...]`` and ``local-cluster[...]`` are.
    """
    context = spark.sparkContext
    local = context.master == "local" or context.master.startswith("local[")
    made = context.getCheckpointDir()
    root = spark.conf.get("spark.checkpoint.dir", None) or made
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_stages"
        local = local or context.master.startswith("local-cluster[")
        refused = not local and _local_only(spark, root)
    else:
        refused = ":/" not in root and not local and _local_only(spark, root)
        if refused and made:
            return made
    if refused:
        raise ValueError(f"spark.checkpoint.dir needs a folder all executors share, not {root}")
    return root


def _delete(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)


def remove_all(spark: SparkSession) -> None:
    """Delete every folder that stages of this session still hold.

    To be called when no result is needed any more that was made by a function which writes stages.
    """
    for root in _ROOTS.pop(spark.sparkContext.applicationId, []):
        _delete(spark, root)


class Stage:
    """A folder of written tables for one iterative job.

    A written table cuts the lineage and survives the loss of executors. Unlike a checkpoint
    it is columnar and has a known size, so Spark can choose the join by it.

    ``close`` removes the tables that the result does not read. As a context manager, a stage is removed
    as a whole if its job fails.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{checkpoint_root(spark).rstrip('/')}/batchkit-{uuid.uuid4().hex}"
        self.names: list[str] = []
        _ROOTS.setdefault(spark.sparkContext.applicationId, []).append(self.root)

    def __enter__(self) -> Stage:
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is not None:
            self.remove()

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def put(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` under ``name``, replacing what was there, and read it back.

        Must not be called with the table that ``df`` reads from. Counting the result is
        cheap: the row count is in the footers of the files.
        """
        df.write.mode("overwrite").parquet(self.path(name))
        if name not in self.names:
            self.names.append(name)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def remove(self, *names: str) -> None:
        """Delete tables that nothing reads any more; without names the whole folder."""
        for path in [self.path(n) for n in names] or [self.root]:
            _delete(self.spark, path)
        self.names = [n for n in self.names if names and n not in names]
        if not names:
            roots = _ROOTS.get(self.spark.sparkContext.applicationId, [])
            if self.root in roots:
                roots.remove(self.root)

    def close(self, *result: str) -> None:
        """Delete all tables but those of the ``result``; the whole folder if there are none."""
        kept = [n for n in self.names if n in result or n.split("/")[0] in result]
        others = [n for n in self.names if n not in kept]
        if not kept:
            self.remove()
        elif others:
            self.remove(*others)
