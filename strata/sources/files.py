"""The few file-system calls that no DataFrame makes, on whatever store the path names."""

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Stored:
    path: str
    at: datetime
    size: int

    @property
    def name(self) -> str:
        return self.path.rsplit("/", 1)[-1]


def _path(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def _stored(status) -> Stored:
    at = datetime.fromtimestamp(status.getModificationTime() / 1000, timezone.utc)
    return Stored(status.getPath().toString(), at, status.getLen())


def found(spark: SparkSession, pattern: str) -> list[Stored]:
    """What matches a glob pattern."""
    hadoop, store = _path(spark, pattern)
    return [_stored(status) for status in store.globStatus(hadoop) or ()]


def matching(spark: SparkSession, pattern: str) -> list[tuple[str, datetime]]:
    """Paths that match a glob pattern, with the time of their last change."""
    return [(s.path, s.at) for s in found(spark, pattern)]


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    hadoop, store = _path(spark, path)
    stream = store.open(hadoop)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds; nothing happens if there is none."""
    hadoop, store = _path(spark, path)
    store.delete(hadoop, True)
