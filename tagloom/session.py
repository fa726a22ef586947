"""Where intermediate tables live, and which frames may be broadcast."""

import contextlib
import contextvars
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may go
    without, and uses a folder beside its tables.
    """
    folder = spark.conf.get(_CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_CHECKPOINT_DIR} to a folder shared by all executors")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return folder.rstrip("/")


_scope = contextvars.ContextVar("scratch_scope", default=None)


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """All scratch folders made within are deleted at its end, also after an error.

    For jobs that leave their results in tables; frames read from the scratch tables are of no use
    afterwards. Scopes within a scope belong to it.
    """
    if _scope.get():
        yield _scope.get()
        return
    folder = f"{shared_folder(spark)}/job-{uuid.uuid4().hex}"
    token = _scope.set(folder)
    try:
        yield folder
    finally:
        _scope.reset(token)
        delete_path(spark, folder)


# Bytecode of a method that HotSpot compiles; a longer one is interpreted for as long as it runs.
_COMPILED_BYTES = 8000


@contextlib.contextmanager
def compiled_wide_rows(spark: SparkSession) -> Iterator[None]:
    """Within, operators whose generated code would be too long to be compiled run one by one, with their
    code in short methods. Meant for rows of many columns."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(_COMPILED_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


class Scratch:
    """A fresh folder of intermediate tables below the shared folder.

    A saved table cuts the lineage and outlives lost executors. It stays until ``drop`` is called
    or the scope ends in which it was made, as frames read from it are lazy.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.folder = f"{_scope.get() or shared_folder(spark)}/{label}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            delete_path(self.spark, self.path(name))


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    fs.delete(hadoop_path, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if there is no folder."""
    fs, hadoop_path = _file_system(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


def create_marker(spark: SparkSession, path: str) -> None:
    """An empty file. It is there or not, as its name is all that it says."""
    fs, hadoop_path = _file_system(spark, path)
    fs.create(hadoop_path, False).close()


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate; an upper guess for joins, file sizes for scans."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def bytes_fit_broadcast(spark: SparkSession, size: int, max_bytes: int | None = None) -> bool:
    """Whether a size is within `max_bytes` (default: Spark's threshold)."""
    if max_bytes is None:
        limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        max_bytes = int(spark._jvm.org.apache.spark.network.util.JavaUtils
                        .byteStringAsBytes(limit)) if not limit.startswith("-") else -1
    return size <= max_bytes


def fits_broadcast(df: DataFrame, max_bytes: int | None = None, growth: int = 1) -> bool:
    """Whether the estimate, times `growth`, is within `max_bytes` (default: Spark's threshold)."""
    return bytes_fit_broadcast(df.sparkSession, growth * estimated_bytes(df), max_bytes)
