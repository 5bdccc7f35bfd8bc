"""Session settings, shared scratch space and the size check that guards every broadcast."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Largest side that may be sent to every executor.
BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 32 * 1024 * 1024

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(app_name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session with the settings the operators rely on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_settings(spark: SparkSession) -> None:
    """Apply the run-time settings to a session somebody else created."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names in ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder; a cluster session must name one.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
            folder = tempfile.mkdtemp(prefix="tidemark-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "kept") -> DataFrame:
    """Write a frame to the shared folder and read it back.

    The plan is computed once and cut, columns are pruned when it is read, and the loss of any executor is survived.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _row_bytes(df: DataFrame) -> Column:
    """Approximate width of a row: text by its length, nested values by their JSON, others fixed."""
    widths = [F.lit(8)]
    for name, kind in df.dtypes:
        value = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            widths.append(F.coalesce(F.octet_length(value), F.lit(0)))
        elif "<" in kind:
            widths.append(F.coalesce(F.octet_length(F.to_json(value)), F.lit(0)))
        else:
            widths.append(F.lit(8))
    return reduce(add, widths)


@dataclass(frozen=True)
class Side:
    """A stored join side: its frame (marked for broadcast if small), and what was measured."""

    frame: DataFrame
    rows: int
    small: bool


def measured(kept: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> Side:
    """Measure a stored frame and mark it for broadcast only if it is proven small.

    Rows and bytes are added up where they lie, so a large side costs one pass and moves no rows. A frame over
    either bound stays unhinted: joins with it are shuffled and adaptive execution splits their hot keys.
    """
    rows, size = kept.agg(F.count(F.lit(1)), F.sum(_row_bytes(kept))).first()
    small = rows <= max_rows and (size or 0) <= max_bytes
    return Side(F.broadcast(kept) if small else kept, rows, small)


def sized_side(df: DataFrame, **bounds: int) -> Side:
    """Store a join side and measure it."""
    return measured(materialize(df, "side"), **bounds)


def small_side(df: DataFrame, **bounds: int) -> DataFrame:
    """A stored join side, marked for broadcast only if it is proven small."""
    return sized_side(df, **bounds).frame


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists on the file system of its path."""
    files, hadoop_path = _file_system(spark, path)
    return files.exists(hadoop_path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder or file this library wrote."""
    files, hadoop_path = _file_system(spark, path)
    files.delete(hadoop_path, True)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders inside a folder; none if it does not exist."""
    files, hadoop_path = _file_system(spark, path)
    if not files.exists(hadoop_path):
        return []
    return sorted(entry.getPath().getName() for entry in files.listStatus(hadoop_path) if entry.isDirectory())


def folder_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the data files in a folder; names that begin with a mark are not data."""
    files, hadoop_path = _file_system(spark, path)
    names = [entry.getPath().getName() for entry in files.listStatus(hadoop_path) if not entry.isDirectory()]
    return sorted(name for name in names if name[0] not in "._")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that is either absent or whole: it gets its name once it is written."""
    files, hadoop_path = _file_system(spark, path)
    _, unfinished = _file_system(spark, f"{path}.unfinished")
    stream = files.create(unfinished, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if not files.rename(unfinished, hadoop_path):
        raise OSError(f"could not name {path}")


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file; a reader between the two steps finds the new text under its unfinished name."""
    files, hadoop_path = _file_system(spark, path)
    _, spare = _file_system(spark, f"{path}.next")
    write_text(spark, f"{path}.next.made", text)
    _, made = _file_system(spark, f"{path}.next.made")
    files.delete(spare, False)
    files.rename(made, spare)
    files.delete(hadoop_path, False)
    if not files.rename(spare, hadoop_path):
        raise OSError(f"could not name {path}")


def read_replaced(spark: SparkSession, path: str) -> str | None:
    """The text that ``replace_text`` wrote last, whole; None if there is none. Finishes a replacement that died."""
    files, hadoop_path = _file_system(spark, path)
    _, spare = _file_system(spark, f"{path}.next")
    if files.exists(spare):
        files.delete(hadoop_path, False)
        files.rename(spare, hadoop_path)
    return read_text(spark, path) if files.exists(hadoop_path) else None


def read_text(spark: SparkSession, path: str) -> str:
    """Text of a small file on the file system of its path."""
    return "\n".join(row.value for row in spark.read.option("wholetext", True).text(path).collect())


@contextmanager
def session_conf(spark: SparkSession, **settings: str):
    """Set configuration keys (dots written as ``__``) for the duration of one action."""
    keys = {name.replace("__", "."): value for name, value in settings.items()}
    before = {key: spark.conf.get(key, None) for key in keys}
    try:
        for key, value in keys.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
