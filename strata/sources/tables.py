"""Layer tables as folders of Parquet files, written and read by Spark's own sources and sinks.

A refresh writes a new folder `<root>/<layer>/<table>/refresh=N`. It counts once Spark's committer has
left its `_SUCCESS` file there, so a refresh that dies changes nothing for readers, who take the latest;
earlier ones stay readable by their number. Rows are added by Spark's append mode, or by a stream that fills a
refresh of its own: then its sink's log says what counts. Bronze tables are filled by streams only, one folder
for each; their versions are the numbers of the batches. One writer per table.
Where a table format with transactions is at hand, its own versions and history serve better.
"""

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.schemas import ENVELOPE, LAYERS
from strata.sources.files import matching
from strata.sources.sink_log import FOLDER, read_log
from strata.streaming.settings import FREE_SHUFFLES, PACKED, settings

HISTORY = """
    version bigint, timestamp timestamp, operation string, operation_parameters map<string,string>,
    operation_metrics map<string,string>, row_count bigint
"""
# Part of the name that Spark gives to all files of one write.
WRITE_ID = r"part-\d+-([0-9a-f-]{36})[^/]*$"


@dataclass(frozen=True)
class Written:
    """What one write did; `metrics` are the counts that the write itself observed, by name."""

    layer: str
    table: str
    version: int
    rows: int
    metrics: dict = field(default_factory=dict, compare=False)


def table_path(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{name}"


def refresh_path(root: str, layer: str, name: str, number: int) -> str:
    return f"{table_path(root, layer, name)}/refresh={number}"


def refreshes(spark: SparkSession, root: str, layer: str, name: str) -> dict[int, datetime]:
    """The finished refreshes by number, with the time of their last write; a stream's counts from its first commit on."""
    path = table_path(root, layer, name)
    marks = matching(spark, f"{path}/refresh=*/_SUCCESS") + matching(spark, f"{path}/refresh=*/{FOLDER}/[0-9]*")
    out: dict[int, datetime] = {}
    for mark, at in marks:
        number = int(mark.split("/refresh=")[-1].split("/")[0])
        out[number] = max(at, out.get(number, at))
    return out


def latest(spark: SparkSession, root: str, layer: str, name: str) -> int | None:
    """The number of the latest refresh, or None for a table that was never written."""
    return max(refreshes(spark, root, layer, name), default=None)


def is_streamed(spark: SparkSession, root: str, layer: str, name: str, number: int) -> bool:
    """Whether a stream fills this refresh."""
    return bool(matching(spark, f"{refresh_path(root, layer, name, number)}/{FOLDER}"))


def written_at(spark: SparkSession, root: str, layer: str, name: str) -> datetime | None:
    """When the latest refresh was last written."""
    known = refreshes(spark, root, layer, name)
    return known[max(known)] if known else None


def bronze_streams(spark: SparkSession, root: str, topic: str) -> list[str]:
    """Folders of the streams that fill a bronze table, one for each checkpoint."""
    return sorted(path.rsplit("/", 1)[0] for path, _ in matching(spark, table_path(root, "bronze", topic) + f"/*/{FOLDER}"))


def bronze_files(spark: SparkSession, root: str, topic: str, version: int) -> list[str]:
    """The files that batches 0 to `version` of every stream of a bronze table have committed.

    A stream that has not got so far yet gives what it has; at least one must have committed a batch of this number.
    """
    logs = [read_log(spark, folder) for folder in bronze_streams(spark, root, topic)]
    known = [log.batches() for log in logs]
    if logs and not any(version in batches for batches in known):
        raise ValueError(f"bronze.{topic} has no version {version}")
    files: list[str] = []
    for log, batches in zip(logs, known):
        last = min(version, max(log.files))
        if last not in batches:
            raise ValueError(f"bronze.{topic} no longer has version {version}")
        files += log.entries(last)
    return sorted(files)


def read_table(spark: SparkSession, root: str, layer: str, name: str, version: int | None = None) -> DataFrame:
    """The table as of a version (default: the latest): of a refresh, or of a batch for a bronze table.

    Of a stream's folder the file source reads what the stream has committed. A table that was never written
    raises path-not-found, a version that it does not have ValueError.
    """
    if layer == "bronze":
        return read_bronze(spark, root, name, version)
    known = refreshes(spark, root, layer, name)
    if known and version is not None and version not in known:
        raise ValueError(f"{layer}.{name} has no version {version}")
    return spark.read.parquet(refresh_path(root, layer, name, max(known, default=0) if version is None else version))


def read_bronze(spark: SparkSession, root: str, topic: str, version: int | None = None) -> DataFrame:
    streams = bronze_streams(spark, root, topic)
    if streams and version is not None:
        files = bronze_files(spark, root, topic, version)
        return spark.read.schema(ENVELOPE).parquet(*files) if files else spark.createDataFrame([], ENVELOPE)
    parts = [spark.read.schema(ENVELOPE).parquet(path) for path in streams or [table_path(root, "bronze", topic)]]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionAll(part)
    return whole


def try_read_table(spark: SparkSession, root: str, layer: str, name: str, version: int | None = None) -> DataFrame | None:
    """The table, or None when it was never written. Other errors are raised."""
    try:
        return read_table(spark, root, layer, name, version)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def file_table(spark: SparkSession, *paths: str) -> DataFrame:
    """path, size, at and rows of the Parquet files in folders, or of files: listed and counted in tasks, from footers alone."""
    read = spark.read.schema("_none boolean").parquet(*paths)
    meta = {"path": "file_path", "size": "file_size", "at": "file_modification_time"}
    return read.groupBy(*[F.col(f"_metadata.{m}").alias(c) for c, m in meta.items()]).agg(F.count(F.lit(1)).alias("rows"))


def _sums() -> list:
    none = F.lit(0).cast("bigint")
    return [
        F.count(F.lit(1)).alias("numFiles"), F.coalesce(F.sum("rows"), none).alias("numOutputRows"), F.coalesce(F.sum("size"), none).alias("numOutputBytes"),
    ]


def sizes_of(spark: SparkSession, *paths: str) -> dict[str, int]:
    """Numbers of files, rows and bytes in folders or files."""
    return file_table(spark, *paths).agg(*_sums()).first().asDict() if paths else {"numFiles": 0, "numOutputRows": 0, "numOutputBytes": 0}


def counted(spark: SparkSession, layer: str, name: str, number: int, *paths: str) -> Written:
    """What a write did, from the footers of the folder or the files it left."""
    rows = spark.read.schema("_none boolean").parquet(*paths).count() if paths else 0
    return Written(layer, name, number, rows, {"numOutputRows": rows})


def files_in(spark: SparkSession, path: str) -> set[str]:
    """The data files of a folder, as Spark lists them."""
    return set(spark.read.schema("_none boolean").parquet(path).inputFiles())


def write_files(df: DataFrame, path: str, mode: str = "error") -> None:
    """The rows as Parquet files; the shuffles that made them go when they are written."""
    with settings(df.sparkSession, FREE_SHUFFLES):
        df.write.mode(mode).options(**PACKED).parquet(path)


def write_snapshot(df: DataFrame, root: str, layer: str, name: str) -> Written:
    """Replace the table and its schema; earlier refreshes stay readable.

    The rows are counted from the footers of the new files: the plan runs once.
    """
    spark = df.sparkSession
    before = latest(spark, root, layer, name)
    number = 0 if before is None else before + 1
    path = refresh_path(root, layer, name, number)
    write_files(df, path, "overwrite")
    return counted(spark, layer, name, number, path)


def append_rows(df: DataFrame, root: str, layer: str, name: str) -> Written:
    """Add rows to the latest refresh; to a new one where there is none. Only the footers of the new files are read."""
    spark = df.sparkSession
    number = latest(spark, root, layer, name)
    if number is None:
        return write_snapshot(df, root, layer, name)
    if is_streamed(spark, root, layer, name, number):
        raise ValueError(f"{layer}.{name} is filled by a stream")
    path = refresh_path(root, layer, name, number)
    before = files_in(spark, path)
    write_files(df, path, "append")
    return counted(spark, layer, name, number, *sorted(files_in(spark, path) - before))


def _stream_commits(spark: SparkSession, folder: str, n: int) -> list[tuple]:
    """The last n batches of a stream's folder: batch, time, sizes of what it added."""
    log, out = read_log(spark, folder), []
    for number, at in sorted(log.batches().items(), reverse=True)[:n]:
        try:
            files = log.added(number)
        except ValueError:  # the batch before a compact file is gone
            continue
        out.append((number, at, sizes_of(spark, *files)))
    return out


def _refresh_commits(spark: SparkSession, path: str, at: datetime) -> list[tuple]:
    """The writes of one refresh, in order: time, sizes. The files of a write share a part of their names."""
    write = F.regexp_extract("path", WRITE_ID, 1)
    writes = file_table(spark, path).groupBy(write.alias("write")).agg(F.max("at").alias("written"), *_sums()).orderBy("written").collect()
    return [(w["written"], {k: w[k] for k in ("numFiles", "numOutputRows", "numOutputBytes")}) for w in writes] or [
        (at, {"numFiles": 0, "numOutputRows": 0, "numOutputBytes": 0})
    ]


def history(spark: SparkSession, root: str, layer: str, name: str, n: int = 10) -> DataFrame:
    """The latest n writes, newest first: version, time, operation, its parameters and metrics, rows.

    WRITE is a refresh (mode Overwrite) or rows added to one (mode Append); STREAMING UPDATE is a batch of a stream. What a write did is
    read from its committed files, their footers and the sink's log.
    """
    text = lambda values: {k: str(v) for k, v in values.items()}
    rows = []

    def streamed(folder: str, version=None) -> None:
        stream = folder.rsplit("/", 1)[-1]
        for number, at, sizes in _stream_commits(spark, folder, n):
            parameters = {"outputMode": "Append", "stream": stream, "batch": number}
            rows.append((number if version is None else version, at, "STREAMING UPDATE", text(parameters), text(sizes), sizes["numOutputRows"]))

    if layer == "bronze":
        for folder in bronze_streams(spark, root, name):
            streamed(folder)
    else:
        for number, at in sorted(refreshes(spark, root, layer, name).items(), reverse=True)[:n]:
            path = refresh_path(root, layer, name, number)
            if is_streamed(spark, root, layer, name, number):
                streamed(path, number)
                continue
            for i, (when, sizes) in enumerate(_refresh_commits(spark, path, at)):
                rows.append((number, when, "WRITE", {"mode": "Append" if i else "Overwrite"}, text(sizes), sizes["numOutputRows"]))
    return spark.createDataFrame(rows, HISTORY).orderBy(F.desc("version"), F.desc("timestamp")).limit(n)


def register_table(spark: SparkSession, root: str, layer: str, name: str, version: int | None = None) -> str:
    """View `layer.name` over the latest version, or `layer.name_vN` over version N.

    The view of a bronze version names the files of its batches, so it fits tables of some thousand files.
    """
    if layer == "bronze" and version is not None:
        folders = {}
        for file in bronze_files(spark, root, name, version):
            folder, _, leaf = file.rpartition("/")
            folders.setdefault(folder, []).append(leaf)
        sources = [f"{folder}/{{{','.join(leaves)}}}" for folder, leaves in folders.items()]
    elif layer == "bronze":
        sources = bronze_streams(spark, root, name)
    else:
        sources = [refresh_path(root, layer, name, latest(spark, root, layer, name) if version is None else version)]
    columns = ", ".join(f"`{c}`" for c in read_table(spark, root, layer, name, version).columns)
    view = f"{layer}.{name}" if version is None else f"{layer}.{name}_v{version}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{root.rstrip('/')}/{layer}'")
    selects = [f"SELECT {columns} FROM parquet.`{s}`" for s in sources]
    if not selects:  # a version without files
        nothing = ", ".join(f"CAST(NULL AS {t}) AS `{c}`" for c, t in read_table(spark, root, layer, name).dtypes)
        selects = [f"SELECT {nothing} WHERE false"]
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS " + " UNION ALL ".join(selects))
    return view


def register_layers(spark: SparkSession, root: str) -> list[str]:
    """A view of every written table by its name. Call it again after a refresh."""
    return [
        register_table(spark, root, layer, name)
        for layer, names in LAYERS.items()
        for name in names
        if (bronze_streams(spark, root, name) if layer == "bronze" else refreshes(spark, root, layer, name))
    ]
