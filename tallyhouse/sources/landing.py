"""Landing files: one folder per retailer and day, JSON inside.

The engine writes JSON Lines, which Spark can split; files that hold one JSON array, as older
producers write them, are read as well. Records are read as ``map<string,string>``, which keeps
number texts exact and tells a missing key from a null value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.operators.analytics import Day, as_day
from tallyhouse.schemas import RECORD_SCHEMA, RETAILERS
from tallyhouse.session import dropping_shuffles

RECORD = "map<string,string>"
PARTITIONS = ("retailer", "year", "month", "day")
_FILE = "struct<file_path:string,file_size:bigint,file_block_start:bigint>"


def partition_columns(date: Column) -> dict[str, Column]:
    """Folder names of a date: month and day with two digits."""
    return {
        "year": F.date_format(date, "yyyy"),
        "month": F.date_format(date, "MM"),
        "day": F.date_format(date, "dd"),
    }


def land(
    records: DataFrame, root: str, replace: bool = True, order: Sequence[str] = (), compression: str | None = None
) -> None:
    """Write records as JSON Lines under ``root/retailer=/year=/month=/day=``.

    With ``replace`` only the folders that get records are overwritten, so a rerun of a day
    replaces that day and nothing is written for a retailer without records; without it ``root``
    must be new, as for a backfill. The rebalance splits a large retailer-day over several files
    and gathers a small one into a single file. Rows that share a shuffle arrive in any order, so
    name the columns of the ``order`` within a file where a loader goes by it. Files with a
    ``compression`` (such as lz4) hold a fraction of the bytes; each is then read by one task.
    """
    spread = records.hint("rebalance", *PARTITIONS)
    if order:
        spread = spread.sortWithinPartitions(*PARTITIONS, *order)
    writer = spread.write.option("ignoreNullFields", False)
    if compression:
        writer = writer.option("compression", compression)
    if replace:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    with dropping_shuffles(spread.sparkSession):
        writer.partitionBy(*PARTITIONS).json(root)


def chunked(records: DataFrame, item: Column, per_file: int) -> DataFrame:
    """The items (texts) of each folder in chunks of about ``per_file``: folder, ``chunk``, ``items``.

    Records are dealt to a folder's chunks by their hash, so no task or value holds more than a chunk
    however large the folder is. Items are sorted within a chunk.
    """
    named = records.select(*PARTITIONS, item.alias("item"))
    dealt = _dealt(named, _sizes(named, per_file))
    return dealt.groupBy(*PARTITIONS, "chunk").agg(F.sort_array(F.collect_list("item")).alias("items"))


def _sizes(named: DataFrame, per_file: int) -> DataFrame:
    """Folder, its ``records`` and in how many ``chunks`` they go."""
    count = F.count("*")
    return named.groupBy(*PARTITIONS).agg(count.alias("records"), F.ceil(count / per_file).alias("chunks"))


def _dealt(named: DataFrame, sizes: DataFrame) -> DataFrame:
    """Folder, ``item`` and the number of its ``chunk``."""
    chunk = F.pmod(F.xxhash64("item"), F.col("chunks"))
    return named.join(sizes, list(PARTITIONS)).select(*PARTITIONS, "item", chunk.alias("chunk"))


def chunk_lines(records: DataFrame, item: Column, per_file: int) -> DataFrame:
    """The chunks of :func:`chunked` with a row for each item: folder, ``chunk``, ``item``, ``place``, ``last``.

    ``place`` counts from 1, ``last`` marks a chunk's last item. See :func:`dealt_records`.
    """
    return placed_items(dealt_records(records, per_file), item)


def dealt_records(records: DataFrame, per_file: int) -> DataFrame:
    """The records with the number of their ``chunk`` in their folder, of about ``per_file`` each, moved there.

    What moves are the records as they are: the items, which are wider texts, are made of them behind that one
    shuffle, which has a task for each third of ``per_file``, so that a task holds few chunks however large
    the table is. The driver sees the folders' names and sizes, as it does in listing them.
    """
    sizes = _sizes(records, per_file)
    found = sizes.collect()
    chunks = F.broadcast(records.sparkSession.createDataFrame(found, sizes.schema).drop("records"))
    own = [name for name, kind in records.dtypes if name not in PARTITIONS and "map<" not in kind]
    chunk = F.pmod(F.xxhash64(*own), F.col("chunks")).alias("chunk")
    # what a chunk's rows have in common comes first, which the shuffle compresses best
    rest = [F.col(name) for name in records.columns if name not in PARTITIONS]
    dealt = records.join(chunks, list(PARTITIONS)).select(*PARTITIONS, chunk, *rest)
    return dealt.repartition(1 + 3 * sum(x["records"] for x in found) // per_file, *PARTITIONS, "chunk")


def placed_items(dealt: DataFrame, item: Column) -> DataFrame:
    """The items of :func:`dealt_records`, sorted in their chunk; never gathered in a list."""
    by = [*PARTITIONS, "chunk"]
    chunk = Window.partitionBy(*by).orderBy("item")
    return dealt.select(*PARTITIONS, item.alias("item"), "chunk").select(
        "*", F.row_number().over(chunk).alias("place"), F.lead(F.lit(True)).over(chunk).isNull().alias("last")
    )


def land_lines(lines: DataFrame, root: str) -> None:
    """Write each chunk's ``value`` lines by ``place`` as one LZ4 file below its folder.

    The rows of a chunk must be in one task, as those of :func:`chunk_lines` are.
    """
    by = [*PARTITIONS, "chunk"]
    # never null, or the writer would turn empty names into null and sort anew, by folder alone
    named = lines.select(*(F.coalesce(F.col(x).cast("string"), F.lit("")).alias(x) for x in by), "place", "value")
    rows = named.sortWithinPartitions(*by, "place").select(*by, "value")
    writer = rows.write.option("maxRecordsPerFile", 0).option("compression", "lz4")
    with dropping_shuffles(rows.sparkSession):
        writer.partitionBy(*by).text(root)


def land_texts(files: DataFrame, root: str) -> None:
    """Write each row's ``value`` as one file of its folder."""
    rows = files.select(*PARTITIONS, "value")
    rows.write.option("maxRecordsPerFile", 1).partitionBy(*PARTITIONS).text(root)


def path_parts(path: Column) -> dict[str, Column]:
    """Retailer and date from a file path; one-digit months and days are padded."""
    def part(name: str) -> Column:
        return F.regexp_extract(path, rf"/{name}=(\d+)/", 1)

    retailer = F.regexp_extract(path, r"/(?:retailer=)?([^/=]+)/year=", 1)
    date = F.concat_ws(
        "-", part("year"), F.lpad(part("month"), 2, "0"), F.lpad(part("day"), 2, "0")
    )
    return {"retailer": retailer, "file_date": date.try_cast("date")}


def _day_glob(root: str, day: Day) -> str:
    day = as_day(day)
    return f"{root}/*/year={day.year:04d}/month={day.month:02d}/day={day.day:02d}"


def scan_files(
    spark: SparkSession,
    root: str,
    day: Day | None = None,
    whole: bool = False,
    pattern: str = "{*.json,*.json.lz4}",
) -> DataFrame:
    """Texts of the JSON files of one day or all days, with file, retailer and date.

    ``whole`` gives one row per file, otherwise one row per line. No folder means no rows.
    """
    reader = spark.read.option("pathGlobFilter", pattern)
    path = root if day is None else _day_glob(root, day)
    try:
        files = reader.option("recursiveFileLookup", True).text(path, wholetext=whole)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], "value string, _metadata " + _FILE)
    return with_file_columns(files)


def _known(retailer: Column) -> Column:
    return retailer.isin([code for _, code, _ in RETAILERS])


def with_file_columns(texts: DataFrame) -> DataFrame:
    """Texts with the columns their ``_metadata`` gives: file, size, offset, retailer and date.

    Only folders of the known retailers count.
    """
    file = F.col("_metadata.file_path")
    return texts.select(
        "value",
        file.alias("file"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("block"),
        *[column.alias(name) for name, column in path_parts(file).items()],
    ).where(_known(F.col("retailer")))


def list_files(spark: SparkSession, root: str, day: Day, pattern: str = "{*.json,*.json.lz4}") -> DataFrame:
    """The JSON files of a day over the known retailers, as deep as they lie; other names are skipped.

    No folder means no rows.
    """
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    try:
        files = found.load(_day_glob(root, day))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], "path string, length bigint")
    retailer = path_parts(F.col("path"))["retailer"]
    return files.select("path", F.col("length").alias("file_size"), retailer.alias("retailer")).where(
        _known(F.col("retailer"))
    )


def _load_order(position: Column) -> Column:
    """Order in which records count as loaded: day, retailer, file, place in the file."""
    return F.struct("file_date", "retailer", "file", "block", position.alias("position"))


def parse_lines(files: DataFrame) -> DataFrame:
    """One record per line. ``record`` is null for a line that is not a JSON object.

    Lines of one block are read in order by one task, so an increasing row id within the block's
    offset gives the place in the file without numbering the file in a single task.
    """
    record = F.from_json("value", RECORD)
    return files.withColumn("row", F.monotonically_increasing_id()).select(
        "retailer", "file_date", "file", "file_size", "block", "row",
        # Exploding one element keeps the optimizer from copying the parse into later filters.
        F.explode(F.array(record)).alias("record"),
    ).select(
        "retailer", "file_date", "file", "file_size", "record",
        _load_order(F.col("row")).alias("load_seq"),
    )


def parse_arrays(files: DataFrame) -> DataFrame:
    """One row per element of files holding a JSON array; the other files give no row."""
    parsed = files.withColumn("records", F.from_json("value", f"array<{RECORD}>"))
    # without outer, Spark would ask twice beforehand whether there are records, and parse the file each time
    return parsed.select(
        "retailer", "file_date", "file", "file_size", "block",
        F.posexplode_outer("records").alias("position", "record"),
    ).where("position is not null").select(
        "retailer", "file_date", "file", "file_size", "position", "record",
        _load_order(F.col("position").cast("bigint")).alias("load_seq"),
    )


def parse_files(spark: SparkSession, lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The records of all files, line files and array files alike, and the rejected files.

    A file whose first sign is ``[`` holds an array and is read whole, by one task; the other files
    are split by lines. ``record`` is null for a line, or an element, that is not a JSON object;
    blank lines are none. The driver sees the names of the array files, as it does in listing them.
    """
    filled = lines.where(F.trim("value") != "").withColumn("row", F.monotonically_increasing_id())
    # a line's number and sign as one number: the least of a block is found without sorting or keeping lines
    mark = F.col("row") * 2 + F.when(F.substring(F.ltrim("value"), 1, 1) == "[", 0).otherwise(1)
    blocks = filled.groupBy("file", "block").agg(F.min(mark).alias("mark"))
    begin = F.min_by("mark", "block").alias("begin")
    names = [row["file"] for row in blocks.groupBy("file").agg(begin).where("begin % 2 = 0").select("file").collect()]
    texts = lines.where(F.trim("value") != "")
    keep = ("retailer", "file_date", "file", "file_size", "record", "load_seq")
    if not names:
        nothing = spark.createDataFrame([], "file string, retailer string, file_date date, reason string")
        return parse_lines(texts).select(*keep), nothing
    jvm = spark._jvm
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name)).toString() for name in names]
    whole = with_file_columns(spark.read.text(paths, wholetext=True))
    # sent to the tasks, which read only the other files' lines on: nothing moves, and no array is parsed by lines
    named = F.broadcast(spark.createDataFrame([(name,) for name in names], "file string"))
    records = parse_lines(texts.join(named, "file", "left_anti")).select(*keep)
    return records.unionByName(parse_arrays(whole).select(*keep)), rejected_files(whole)


def rejected_files(files: DataFrame) -> DataFrame:
    """Files that are not a JSON array, or an empty one, with the reason."""
    parsed = F.from_json("value", f"array<{RECORD}>")
    opens = F.substring(F.ltrim("value"), 1, 1)
    reason = (
        F.when(F.length(F.trim("value")) == 0, "empty file")
        .when(parsed.isNull() & (opens == "{"), "not an array")
        .when(parsed.isNull(), "not JSON")
        .when(F.size(parsed) == 0, "no records")
    )
    return files.withColumn("reason", reason).where("reason is not null").select(
        "file", "retailer", "file_date", "reason"
    )


def inventory(parsed: DataFrame) -> DataFrame:
    """Per file: size, number of records and the keys of its first record.

    Records are counted by their keys first, with the place of the first one that has them: a file has few
    sets of keys, so no record is sorted.
    """
    file = ["retailer", "file_date", "file", "file_size"]
    alike = parsed.groupBy(*file, "load_seq.block", F.map_keys("record").alias("record_keys")).agg(
        F.count("*").alias("records"), F.min("load_seq.position").alias("first")
    )
    return alike.groupBy(*file).agg(
        F.sum("records").alias("records"),
        F.min_by("record_keys", F.struct("block", "first")).alias("record_keys"),
    )


def retailer_inventory(files: DataFrame, *more: Column) -> DataFrame:
    """Per retailer: files, bytes and records, from the per-file inventory, and ``more`` aggregates."""
    return files.groupBy("retailer").agg(
        F.count("*").alias("files"),
        F.sum("file_size").alias("bytes"),
        F.sum("records").alias("records"),
        *more,
    )


def day_summary(listed: DataFrame, loaded_files: DataFrame, inserted: DataFrame) -> DataFrame:
    """Per retailer: files found, those that gave records, these records, and the facts they added.

    ``listed`` has a row per file of the day, ``loaded_files`` one per record with its file.
    """
    found = listed.groupBy("retailer").agg(F.count("*").alias("files_found"))
    processed = loaded_files.groupBy("retailer").agg(
        F.count_distinct("file").alias("files_processed"), F.count("*").alias("records_found")
    )
    counts = ["files_processed", "records_found", "records_loaded"]
    return found.join(processed, "retailer", "left").join(inserted, "retailer", "left").na.fill(0, counts)


def external_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Name the landed JSON Lines as a table of the catalogue for ad-hoc SQL; dropping it keeps the files.

    Columns are declared, so no file is read to find them, and each folder is a partition that the
    catalogue knows, so a query lists and reads the folders it asks for. A line that is no JSON object,
    or a value of another type, leaves the line's text in ``unreadable``. Folders that come later are
    there after ``spark.catalog.recoverPartitions(name)``.
    """
    columns = [f"{field.name} {field.dataType.simpleString()}" for field in RECORD_SCHEMA]
    dated = [x.replace("timestamp_ntz", "string") for x in columns]  # as delivered, readable or not
    folders = ", ".join(f"{x} string" for x in PARTITIONS)
    place = root.replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({', '.join(dated)}, unreadable string, {folders}) USING json "
        f"OPTIONS (path '{place}', columnNameOfCorruptRecord 'unreadable') PARTITIONED BY ({', '.join(PARTITIONS)})"
    )
    spark.catalog.recoverPartitions(name)
    return spark.table(name)
