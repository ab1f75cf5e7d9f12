"""Stage tables: a frame written once and read back.

Used where a frame feeds several others. It cuts the lineage on shared storage,
so a lost executor costs no recomputation, and the size of the written files is
what the planner checks before it broadcasts a relationship.
"""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from regraft.sources.files import Files
from regraft.sources.sinks import readable

CHECKPOINT_DIR = "spark.checkpoint.dir"
JOBS_AT_ONCE = 6
CLUSTERED_BY, BUCKETS_FILE = "old_id", "_buckets"

T = TypeVar("T")


def at_once(jobs: Sequence[Callable[[], T]]) -> list[T]:
    """Submit independent Spark jobs together, so short ones fill the cluster."""
    if len(jobs) < 2:
        return [job() for job in jobs]
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        return [f.result() for f in [pool.submit(inherit(job)) for job in jobs]]


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; in local mode without one, a folder of the warehouse."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    return spark.conf.get("spark.sql.warehouse.dir") + "/stages"


def _codec(frame: DataFrame) -> str:
    """Pairs stay lightly packed: the planner takes the size of their files for that of a broadcast."""
    return "zstd" if len(frame.columns) > 2 else "snappy"


def _forget(spark: SparkSession, table: str) -> None:
    """Takes a table out of the catalog; its files stay."""
    if spark.sparkContext._jsc is not None:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def _remove(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None:  # else the session has ended
        Files(spark, path).remove("")


class Keeper:
    """``keep`` of the operators: writes below a folder of a staging."""

    def __init__(self, staging: Staging, folder: str = "") -> None:
        self.staging, self.folder, self.buckets = staging, folder, staging.buckets

    def __call__(self, name: str, frame: DataFrame) -> DataFrame:
        return self.staging.write(self.folder + name, frame)


class Staging:
    """A folder of stage tables. With a fixed root a rerun finds them again; without, they go at the program's end.

    With ``buckets``, a frame with an ``old_id`` is shuffled by it once, when it is
    written: each bucket is one sorted file, and a join on ``old_id`` reads the files
    as they lie. A file beside them tells the number, and each session makes the
    table known to its catalog under a name of its own.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, buckets: int = 0) -> None:
        self.spark = spark
        self.buckets = buckets
        self.root = root or f"{shared_folder(spark)}/regraft/{uuid.uuid4().hex}"
        if root is None:
            atexit.register(_remove, spark, self.root)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def has(self, name: str) -> bool:
        """Whether the table was written to its end."""
        return readable(self.spark, self.path(name))

    def read(self, name: str) -> DataFrame:
        plain = self.spark.read.parquet(self.path(name))
        buckets = self._buckets(name)
        return self._clustered(name, plain, buckets) if buckets else plain

    def write(self, name: str, frame: DataFrame) -> DataFrame:
        path = self.path(name)
        if not self.buckets or CLUSTERED_BY not in frame.columns:
            frame.write.mode("overwrite").option("compression", _codec(frame)).parquet(path)
            return self.spark.read.schema(frame.schema).parquet(path)
        table = self._table(name)
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        dealt = frame.repartition(self.buckets, CLUSTERED_BY).write.mode("overwrite").format("parquet")
        dealt = dealt.option("compression", _codec(frame))
        dealt.bucketBy(self.buckets, CLUSTERED_BY).sortBy(CLUSTERED_BY).option("path", path).saveAsTable(table)
        Files(self.spark, path).put(BUCKETS_FILE, str(self.buckets))
        atexit.register(_forget, self.spark, table)
        return self.spark.table(table)

    def keep(self, name: str, frame: DataFrame) -> DataFrame:
        return self.write(name, frame)

    def keeper(self, folder: str = "") -> Keeper:
        return Keeper(self, folder)

    def _table(self, name: str) -> str:
        return f"regraft_{uuid.uuid5(uuid.NAMESPACE_URL, self.path(name)).hex}"

    def _buckets(self, name: str) -> int:
        files = Files(self.spark, self.path(name))
        return int(files.read(BUCKETS_FILE)) if files.exists(BUCKETS_FILE) else 0

    def _clustered(self, name: str, plain: DataFrame, buckets: int) -> DataFrame:
        table, path = self._table(name), self.path(name).replace("\\", "\\\\").replace("'", "\\'")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema)
        by = f"CLUSTERED BY ({CLUSTERED_BY}) SORTED BY ({CLUSTERED_BY}) INTO {buckets} BUCKETS"
        if not self.spark.catalog.tableExists(table):
            self.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {by} LOCATION '{path}'")
            atexit.register(_forget, self.spark, table)
        return self.spark.table(table)
