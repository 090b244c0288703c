"""Tables laid out by the date of their events, changed date by date, and streams' folders with few files.

A dated table has a column `event_date` (NULL where the time is unreadable) by which its files lie in folders, so that a filter on it reads
only those. It is the day, or with unit "month" the first day of the month, for histories with few rows a day. Rows of a date are dealt to writers by `rebalance`: small dates share a task, a hot date is split over several, each
date has few files. Late events change the folders of their own dates by Spark's dynamic partition overwrite.

A stream appends a file or more with each batch. `compact_bronze` writes the rows of its first batches as few files beside it, and readers take
those and the later batches' files, as the sink's log names them.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.schemas import ENVELOPE
from strata.sources import tables
from strata.sources.files import matching, remove
from strata.sources.sink_log import read_log
from strata.sources.tables import Written
from strata.streaming.settings import FREE_SHUFFLES, PACKED, settings

EVENT_DATE = "event_date"


def dated(rows: DataFrame, time: str = "event_ts", unit: str = "day") -> DataFrame:
    return rows.withColumn(EVENT_DATE, F.to_date(F.date_trunc(unit, F.col(time))))


def _write_by_date(rows: DataFrame, path: str, **options: str) -> None:
    """Replaces the files in a folder by rows by date: each date in few files."""
    with settings(rows.sparkSession, FREE_SHUFFLES):
        rows.hint("rebalance", F.col(EVENT_DATE)).write.partitionBy(EVENT_DATE).mode("overwrite").options(**PACKED, **options).parquet(path)


def write_dated(rows: DataFrame, root: str, layer: str, name: str, time: str = "event_ts", unit: str = "day") -> Written:
    """A new refresh of the table, laid out by the date of `time`."""
    spark = rows.sparkSession
    before = tables.latest(spark, root, layer, name)
    number = 0 if before is None else before + 1
    path = tables.refresh_path(root, layer, name, number)
    _write_by_date(dated(rows, time, unit), path)
    return tables.counted(spark, layer, name, number, path)


def replace_dates(rows: DataFrame, root: str, layer: str, name: str, time: str = "event_ts", unit: str = "day") -> Written:
    """The latest refresh with all rows of the dates in `rows` replaced by them; the files of other dates are not touched.

    `rows` may be made from the table itself: Spark writes all new files before it changes the dates' folders.
    """
    spark = rows.sparkSession
    number = tables.latest(spark, root, layer, name)
    if number is None:
        return write_dated(rows, root, layer, name, time, unit)
    path = tables.refresh_path(root, layer, name, number)
    before = tables.files_in(spark, path)
    _write_by_date(dated(rows, time, unit), path, partitionOverwriteMode="dynamic")
    return tables.counted(spark, layer, name, number, *sorted(tables.files_in(spark, path) - before))


def between(rows: DataFrame, first=None, last=None, time: str = "event_ts", unit: str = "day") -> DataFrame:
    """The rows of days `first` to `last` (both included, None: open); only the files of their dates are read."""
    day = F.to_date(F.col(time))
    if first is not None:
        start = F.lit(first).cast("date")
        rows = rows.where((F.col(EVENT_DATE) >= F.to_date(F.date_trunc(unit, start))) & (day >= start))
    if last is not None:
        end = F.lit(last).cast("date")
        rows = rows.where((F.col(EVENT_DATE) <= end) & (day <= end))
    return rows


def date_folders(spark: SparkSession, root: str, layer: str, name: str) -> list[str]:
    """The dates that the latest refresh has rows of, ascending, from the names of its folders."""
    path = tables.refresh_path(root, layer, name, tables.latest(spark, root, layer, name) or 0)
    found = [folder.rsplit("=", 1)[-1] for folder, _ in matching(spark, f"{path}/{EVENT_DATE}=*")]
    return sorted(d for d in found if d[0].isdigit())


def latest_dates(spark: SparkSession, root: str, layer: str, name: str, n: int = 10) -> DataFrame:
    """The rows of the latest n dates; no other date's files are opened."""
    rows = tables.read_table(spark, root, layer, name)
    dates = date_folders(spark, root, layer, name)[-n:]
    return rows.where(F.col(EVENT_DATE).isin([F.lit(d).cast("date") for d in dates])) if dates else rows.limit(0)


def touches(dates: DataFrame) -> Column:
    """Whether a row's date is one of the few in `dates` (event_date), which come to the driver; NULL is a date of its own."""
    few = [row[0] for row in dates.select(EVENT_DATE).distinct().collect()]
    known = [F.lit(d) for d in few if d is not None]
    hit = F.col(EVENT_DATE).isin(known) if known else F.lit(False)
    return hit | F.col(EVENT_DATE).isNull() if None in few else hit


# Streams' folders

def packed_path(root: str, topic: str, stream: str, number: int) -> str:
    return f"{root.rstrip('/')}/bronze/_packed/{topic}/{stream}/through={number}"


def packed_through(spark: SparkSession, root: str, topic: str, stream: str) -> int | None:
    """The number of the last batch in the packed files of a stream."""
    marks = matching(spark, f"{root.rstrip('/')}/bronze/_packed/{topic}/{stream}/through=*/_SUCCESS")
    return max((int(p.split("through=")[-1].split("/")[0]) for p, _ in marks), default=None)


def _later(spark: SparkSession, folder: str, through: int | None) -> list[str]:
    """The files of a stream's folder that came after batch `through`."""
    log = read_log(spark, folder)
    last = max(log.batches(), default=None)
    if last is None:
        return []
    packed = set() if through is None else set(log.entries(through))
    return sorted(set(log.entries(last)) - packed)


def compact_bronze(spark: SparkSession, root: str, topic: str) -> dict[str, int]:
    """Packs all that the topic's streams have committed into few files; the number of the last packed batch of each stream.

    Packed files are made from those before and the later batches; the older ones go. The streams' own files stay: versions and streams that read
    the folder need them.
    """
    done = {}
    for folder in tables.bronze_streams(spark, root, topic):
        stream = folder.rsplit("/", 1)[-1]
        last = max(read_log(spark, folder).batches(), default=None)
        before = packed_through(spark, root, topic, stream)
        if last is None:
            continue
        done[stream] = last
        if last == before:
            continue
        read_packed(spark, root, topic, stream).hint("rebalance").write.mode("overwrite").parquet(packed_path(root, topic, stream, last))
        if before is not None:
            remove(spark, packed_path(root, topic, stream, before))
    return done


def read_packed(spark: SparkSession, root: str, topic: str, stream: str) -> DataFrame:
    """All rows of one stream of a bronze table, from the packed files and those that came later."""
    through = packed_through(spark, root, topic, stream)
    paths = [] if through is None else [packed_path(root, topic, stream, through)]
    paths += _later(spark, f"{tables.table_path(root, 'bronze', topic)}/{stream}", through)
    return spark.read.schema(ENVELOPE).parquet(*paths) if paths else spark.createDataFrame([], ENVELOPE)


def read_compacted(spark: SparkSession, root: str, topic: str) -> DataFrame:
    """The bronze table as of now, with few files whatever the number of batches before the last compaction."""
    parts = [read_packed(spark, root, topic, folder.rsplit("/", 1)[-1]) for folder in tables.bronze_streams(spark, root, topic)]
    whole = parts[0] if parts else tables.read_bronze(spark, root, topic)
    for part in parts[1:]:
        whole = whole.unionAll(part)
    return whole
