"""Session, shared-folder and table helpers used by every layer."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "millrace", master: str | None = None, partitions: int | None = None) -> SparkSession:
    """A UTC session with AQE on. Cluster sizing stays with spark-submit; `master` is for local runs."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master).config("spark.driver.memory", os.environ.get("MILLRACE_DRIVER_MEMORY", "12g"))
    if partitions:
        b = b.config("spark.sql.shuffle.partitions", str(partitions))
    return (
        b.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One table of a data folder; parquet readers prune its columns and push its filters."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where it is unset, a temporary folder serves, but only for a single-JVM master (tests).
    """
    there = spark.conf.get("spark.checkpoint.dir", None)
    if there:
        return there.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    there = f"file://{tempfile.mkdtemp(prefix='millrace-')}"
    spark.conf.set("spark.checkpoint.dir", there)
    return there


_OWNERS: list[list[str]] = []


@contextlib.contextmanager
def owned(spark: SparkSession):
    """Removes, at its end, what operators inside have put into the shared folder: write results out inside. Owners may be nested; the innermost removes."""
    mine: list[str] = []
    _OWNERS.append(mine)
    try:
        yield
    finally:
        _OWNERS.remove(mine)
        for base in mine:
            _delete(spark, base)


def _delete(spark: SparkSession, at: str) -> None:
    with contextlib.suppress(Exception):
        p = spark._jvm.org.apache.hadoop.fs.Path(at)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


class Stash:
    """Tables written in the shared folder to cut lineage, so that a lost executor costs no recomputation.

    `put` writes and rereads a frame. `drop` deletes tables that nothing still to run needs; what a
    returned DataFrame reads must stay until its reader is done: owned() removes it then, and without an owner it stays in the folder.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.tables = 0
        if _OWNERS:
            _OWNERS[-1].append(self.base)

    def path(self) -> str:
        self.tables += 1
        return f"{self.base}/{self.tables}"

    def put(self, df: DataFrame, at: str | None = None, codec: str = "zstd") -> DataFrame:
        at = at or self.path()
        df.write.mode("overwrite").option("compression", codec).parquet(at)
        return self.spark.read.schema(df.schema).parquet(at)

    def drop(self, *frames: DataFrame) -> None:
        plain = lambda path: path.split(":", 1)[-1].lstrip("/")
        for df in frames:
            for top in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
                if plain(top).startswith(plain(self.base)):
                    _delete(self.spark, top)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
