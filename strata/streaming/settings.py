"""Session settings for the time that a streaming query starts or a table is written: the query keeps them, the session gets its own back."""

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# All batches stay in the log of the file sink, so that a table's versions stay readable.
KEEP_LOG = {"spark.sql.streaming.fileSink.log.deletion": "false"}
# State on the executors' disks, with snapshots and changes in the checkpoint: not bound by the heap.
DISK_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # An ended query's state leaves the executors' disks at the next maintenance; what a store reserves there is 4 MB a partition at least.
    "spark.sql.streaming.stateStore.maintenanceInterval": "20s",
}
# The shuffles of a write or a batch leave the disks when it ends, not when the driver happens to collect its garbage.
FREE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
# Options of a writer: files smaller than by the default codec. A file sink does not see the settings that its query keeps.
PACKED = {"compression": "zstd"}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
