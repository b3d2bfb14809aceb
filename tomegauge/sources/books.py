"""Books as files: list them, read them whole.

A folder of up to ``FEW`` files is listed and read by Spark's own reader, whose index is on the driver, some kilobytes
a file with the tasks made of it. A larger one in a mounted folder is listed by tasks into a stored table
and its files are opened by tasks, so the driver holds nothing per file. Both give the same rows.
"""

import os
import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tomegauge.functions import text
from tomegauge.session import scratch_path


LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
OPEN_COST = "spark.sql.files.openCostInBytes"

#: What opening a small file counts for where tasks are cut: some 500 such files make a task, not 32.
SMALL_FILE = "256k"

#: Files of a folder up to which the driver holds the listing.
FEW = 20_000

#: Files and bytes that a task opens where tasks read a listing.
TASK_FILES, TASK_BYTES = 2000, 64 << 20

#: Bytes of a batch of file contents or lines that a task holds, but for a longer file or line.
BATCH_BYTES = 8 << 20


@contextmanager
def _set(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def _listed_by_few(spark: SparkSession):
    """Many folders or files are listed by tasks, a few per core rather than one for each."""
    return _set(spark, LISTING_TASKS, str(4 * spark.sparkContext.defaultParallelism))


def small_files(spark: SparkSession):
    """Within it whatever is run reads small files by hundreds a task. A longer file still fills a task by its bytes."""
    return _set(spark, OPEN_COST, SMALL_FILE)


def _mounted(spark: SparkSession, root: str) -> str | None:
    """The folder by which this machine, and so each executor, opens ``root``; None in other stores."""
    if not root.startswith("file:"):
        if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", root) or any(c in root for c in "*?[{"):
            return None
        if not spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///").startswith("file:"):
            return None
    folder = os.path.abspath(re.sub(r"\Afile:(//[^/]*)?", "", root))
    return folder if os.path.isdir(folder) else None


def _more_than(folder: str, most: int) -> bool:
    """Whether a folder holds more files than that; no more of them are looked at."""
    there, found = [folder], 0
    while there:
        with os.scandir(there.pop()) as entries:
            for entry in entries:
                if entry.is_dir():
                    there.append(entry.path)
                else:
                    found += 1
                    if found > most:
                        return True
    return False


def _entries_of(glob: str | None):
    """Lists folders: a row for each file and each folder in them, but for those that Spark passes over as well."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import unicodedata
        from fnmatch import fnmatchcase

        legal = {chr(c) for c in range(128) if chr(c).isalnum()} | set("-_.!~*'():@&=+$,;/")

        def escaped(path: str) -> str:
            # As java.net.URI does, which the addresses of Spark come from.
            plain = (c in legal or ord(c) > 127 and unicodedata.category(c) not in ("Zs", "Zl", "Zp", "Cc") for c in path)
            return "".join(c if as_is else "".join(f"%{b:02X}" for b in c.encode()) for c, as_is in zip(path, plain, strict=True))

        names = ["path", "address", "length", "modified", "folder"]
        kinds = pa.schema([("path", pa.string()), ("address", pa.string()), ("length", pa.int64()), ("modified", pa.timestamp("us", "UTC")), ("folder", pa.bool_())])
        rows = []

        def made():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds.types, strict=True)], names)

        for batch in batches:
            for folder in batch.column(0).to_pylist():
                with os.scandir(re.sub(r"\Afile:", "", folder)) as entries:
                    for entry in entries:
                        name = entry.name
                        if name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_"):
                            continue
                        is_folder = entry.is_dir()
                        if not is_folder and glob is not None and not fnmatchcase(name, glob):
                            continue
                        try:
                            stat = entry.stat()
                        except FileNotFoundError:  # gone meanwhile, or a link to nowhere
                            continue
                        if not is_folder and not stat.st_size:
                            continue
                        rows.append((f"file:{entry.path}", f"file:{escaped(entry.path)}", stat.st_size, stat.st_mtime_ns // 10**6 * 1000, is_folder))
                        if len(rows) == 10_000:
                            yield made()
                            rows.clear()
        if rows:
            yield made()

    return run


_ENTRIES = "path string, address string, length long, modified timestamp, folder boolean"


def ranked(files: DataFrame, *columns: str) -> DataFrame:
    """Stored rows of files with ``place``, their number in the order of their addresses; the driver sees a number per range."""
    spark = files.sparkSession
    home, parts = scratch_path(spark, "listing"), max(1, min(4 * spark.sparkContext.defaultParallelism, files.count() // TASK_FILES))
    dealt = files.select("address", *columns).repartitionByRange(parts, "address").sortWithinPartitions("address")
    # Within a task the rows are in order, so their ids are.
    dealt.withColumns({"id": F.monotonically_increasing_id(), "part": F.spark_partition_id()}).write.parquet(home)
    rows = spark.read.parquet(home)
    counts = {row.part: row["count"] for row in rows.groupBy("part").count().collect()}
    before = list(accumulate((counts.get(part, 0) for part in range(parts)), initial=0))
    first = F.element_at(F.array(*map(F.lit, before[:-1])), F.col("part") + 1)
    in_part = F.col("id").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.withColumn("place", (first + in_part).cast("long")).drop("id", "part")


def _listed_by_tasks(spark: SparkSession, folder: str, glob: str | None) -> DataFrame:
    """The files below a mounted folder: a job lists the folders of a level, each folder in one task, and stores what is in them."""
    home = scratch_path(spark, "entries")
    folders, count, level = spark.createDataFrame([(f"file:{folder}",)], "path string"), 1, 0
    while count:
        found = f"{home}/level={level}"
        few = folders.repartition(min(count, 4 * spark.sparkContext.defaultParallelism))
        few.mapInArrow(_entries_of(glob), _ENTRIES).write.parquet(found)
        folders, level = spark.read.schema(_ENTRIES).parquet(found).where("folder").select("path"), level + 1
        count = folders.count()
    return spark.read.schema(_ENTRIES).parquet(*[f"{home}/level={k}" for k in range(level)]).where("not folder")


def as_index(rows: DataFrame) -> DataFrame:
    """Stored rows of files with the columns by which the functions here know an index, but for the contents."""
    hidden = F.struct(F.col("address").alias("file_path"), F.col("length").alias("file_size"))
    return rows.select("path", F.col("modified").alias("modificationTime"), "length", hidden.alias("_metadata"), "place")


def is_stored(files: DataFrame) -> bool:
    """Whether an index is a stored listing, of which the driver holds nothing."""
    return "content" not in files.columns


def index(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """The files below a folder, listed once.

    Whatever is derived from this frame (``files=`` of the functions here) uses the
    same listing. Many folders are listed by tasks, a few per core rather than one per folder. More than ``FEW`` files
    in a mounted folder come as a stored listing without their contents.
    """
    folder = _mounted(spark, root) if glob is None or not set(glob) & set("[]{}\\") else None
    if folder is not None and _more_than(folder, FEW):
        return as_index(ranked(_listed_by_tasks(spark, folder, glob), "path", "length", "modified"))
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    with _listed_by_few(spark):
        return reader.load(root)


def address() -> Column:
    """The address of a file as filters on it see it: with it files are dropped before they become tasks."""
    return F.col("_metadata.file_path")


def _name(root: str, path: Column | str = "path") -> Column:
    """The path below the folder that holds ``root``, so that the folder's own name leads: ``txt/10.txt``."""
    folder = root.rstrip("/").rsplit("/", 1)[-1]
    return F.concat(F.lit(f"{folder}/"), F.substring_index(path, f"/{folder}/", -1))


def list_books(
    spark: SparkSession, root: str, limit: int | None = None, glob: str | None = None, files: DataFrame | None = None
) -> DataFrame:
    """``fileName, path, length`` of the files under a folder, the first ``limit`` in path order.

    Folders themselves are not listed. File contents are not read, so a few tasks a core do, whatever the
    number of files.
    """
    files = index(spark, root, glob) if files is None else files
    few = files.coalesce(4 * spark.sparkContext.defaultParallelism)
    listed = few.select(_name(root).alias("fileName"), "path", "length")
    return listed if limit is None else listed.orderBy("path").limit(limit)


def listing(files: DataFrame, root: str) -> DataFrame:
    """``address, fileName, length, modified`` of an index; no file is opened."""
    return files.select(
        address().alias("address"), _name(root).alias("fileName"), "length", F.col("modificationTime").alias("modified")
    )


def large_files(files: DataFrame, above: int) -> list[str] | DataFrame | None:
    """Paths of the files above a size; no more than the listing that the driver holds as it is.

    Of a stored listing its rows of these files, None if there are none.
    """
    if is_stored(files):
        long = files.where(F.col("length") > above)
        return None if long.isEmpty() else long
    return list(large_addresses(files, above).values())


def large_addresses(files: DataFrame, above: int) -> dict[str, str]:
    """The paths of ``large_files`` by their addresses."""
    found = files.where(F.col("_metadata.file_size") > above).select(address().alias("address"), "path")
    return {row.address: row.path for row in found.collect()}


def _last_stored(files: DataFrame, limit: int | None, after: str | None) -> str | None:
    """``last_file`` of a stored listing, whose places count all files."""
    if after is not None:
        files = files.where(address() > after)
    if limit is not None:
        first = files.agg(F.min("place")).first()[0]
        files = files.where(F.col("place") < (first or 0) + limit)
    return files.agg(F.max(address())).first()[0]


def last_file(
    spark: SparkSession,
    root: str,
    limit: int | None = None,
    glob: str | None = None,
    after: str | None = None,
    files: DataFrame | None = None,
) -> str | None:
    """Address of the last of the first ``limit`` files that come after an address, from the listing alone."""
    files = index(spark, root, glob) if files is None else files
    if is_stored(files):
        return _last_stored(files, limit, after)
    files = files.select(address().alias("address"))
    files = files if after is None else files.where(F.col("address") > after)
    files = files if limit is None else files.orderBy("address").limit(limit)
    with small_files(spark):
        return files.agg(F.max("address")).first()[0]


def _dealt(rows: DataFrame, files: int, size: int) -> DataFrame:
    """Rows that name files, shared out so that a task opens some thousand files or some dozen MB of them, in any order."""
    tasks = max(min(files, rows.sparkSession.sparkContext.defaultParallelism), -(-files // TASK_FILES), -(-size // TASK_BYTES), 1)
    return rows.repartition(tasks)


def _count_and_size(files: DataFrame) -> tuple[int, int]:
    return tuple(files.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first())


def _opened(most: int):
    """Adds the bytes of files to batches of their paths; a batch holds ``most`` bytes, or one longer file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, contents, held = [], [], 0
            for path in batch.column(0).to_pylist():
                with open(re.sub(r"\Afile:", "", path), "rb") as file:
                    content = file.read()
                if contents and held + len(content) > most:
                    yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(contents, pa.binary())], ["path", "content"])
                    paths, contents, held = [], [], 0
                paths.append(path)
                contents.append(content)
                held += len(content)
            if contents:
                yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(contents, pa.binary())], ["path", "content"])

    return run


def _contents(
    spark: SparkSession,
    root: str,
    limit: int | None,
    glob: str | None,
    after: str | None = None,
    last: str | None = None,
    files: DataFrame | None = None,
) -> DataFrame:
    """Files with their bytes; with bounds only those between are opened.

    The last path wanted is found from the listing alone. As filters on the
    file metadata the bounds drop the other files before they become tasks.
    """
    files = index(spark, root, glob) if files is None else files
    if limit is not None:
        last = last_file(spark, root, limit, glob, after, files)
        files = files.where(F.lit(last is not None))
    if after is not None:
        files = files.where(address() > after)
    files = files if last is None else files.where(address() <= last)
    if is_stored(files):
        return _dealt(files.select("path"), *_count_and_size(files)).mapInArrow(_opened(BATCH_BYTES), "path string, content binary")
    return files


def read_books(
    spark: SparkSession,
    root: str,
    limit: int | None = None,
    glob: str | None = None,
    strict: bool = True,
    after: str | None = None,
    last: str | None = None,
    files: DataFrame | None = None,
) -> DataFrame:
    """One row per file: ``fileName, rawDocument``, line feeds as spaces.

    ``limit`` takes the first files by address, those above ``after`` if given; ``last`` is the last address read.
    ``files`` is an index of ``root`` that may have been filtered; without it the folder is listed.

    Text must be UTF-8: a file that is not fails the job, or with
    ``strict=False`` has a NULL text (see ``broken_books``).
    """
    content = F.col("content").cast("string")
    checked = F.validate_utf8(content) if strict else F.try_validate_utf8(content)
    return _contents(spark, root, limit, glob, after, last, files).select(
        _name(root).alias("fileName"),
        text.newlines_to_spaces(checked).alias("rawDocument"),
    )


#: Lines of a chunk of a large file.
CHUNK_LINES = 4096


def _lines_of(most: int):
    """The lines that begin in a block of a file: ``path, start, id, value``; ``id`` counts them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made():
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["path", "start", "id", "value"])

        rows, held = [], 0
        for batch in batches:
            for path, start, end in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                with open(re.sub(r"\Afile:", "", path), "rb") as file:
                    if start:
                        file.seek(start - 1)
                        while (skipped := file.readline(most)) and not skipped.endswith(b"\n"):
                            pass
                    count = 0
                    while file.tell() < end and (line := file.readline()):
                        rows.append((path, start, count, line.removesuffix(b"\n")))
                        count, held = count + 1, held + len(line)
                        if held > most or len(rows) == 10_000:
                            yield made()
                            rows, held = [], 0
        if rows:
            yield made()

    return run


def _stored_lines(files: DataFrame) -> DataFrame:
    """The lines of files of a stored listing, in blocks that tasks read."""
    count, size = _count_and_size(files)
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(TASK_BYTES).cast("long"))).alias("start")
    blocks = files.where("length > 0").select("path", starts, "length")
    blocks = blocks.select("path", "start", F.least(F.col("start") + TASK_BYTES, F.col("length")).alias("end"))
    lines = _dealt(blocks, count, size).mapInArrow(_lines_of(BATCH_BYTES), "path string, start long, id long, value binary")
    return lines.withColumn("value", F.col("value").cast("string"))


def read_chunks(
    spark: SparkSession, root: str, paths: Sequence[str] | DataFrame, strict: bool = True, lines: int = CHUNK_LINES
) -> DataFrame:
    """Large files by lines: ``fileName, chunk, rawDocument``, the texts of a file's chunks in order making up the file.

    Files are split into blocks of ``spark.sql.files.maxPartitionBytes``, so many tasks read one, and
    no row holds more than ``lines`` lines. Line feeds become spaces, as in ``read_books``; text that is not UTF-8
    fails the job, or leaves its lines out with ``strict=False``. A single line must fit a row.
    Of a stored listing ``paths`` are its rows of these files.
    """
    rows = _stored_lines(paths) if isinstance(paths, DataFrame) else _spark_lines(spark, paths)
    checked = F.validate_utf8("value") if strict else F.coalesce(F.try_validate_utf8("value"), F.lit(""))
    rows = rows.withColumn("line", checked).withColumn("part", F.floor(F.col("id") / lines))
    ordered = F.array_sort(F.collect_list(F.struct("id", "line")))["line"]
    chunks = rows.groupBy("path", "start", "part").agg(F.concat(F.array_join(ordered, " "), F.lit(" ")).alias("rawDocument"))
    return chunks.select(_name(root).alias("fileName"), F.struct("start", "part").alias("chunk"), "rawDocument")


def _spark_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The lines of files in the blocks that Spark's reader makes."""
    escaped = [re.sub(r"([\[\]{}*?\\])", r"\\\1", path) for path in paths]
    # Without the recursive option Spark would look for columns in the names of their folders.
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true")
    with _listed_by_few(spark):
        rows = reader.text(escaped)
    place = F.url_decode(F.replace(address(), F.lit("+"), F.lit("%2B")))
    # Within a task the lines of a block come in order, so their ids do.
    return rows.select(
        place.alias("path"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("id"), "value"
    )


def broken_books(books: DataFrame) -> DataFrame:
    """Names of the books whose text could not be decoded."""
    return books.where(F.col("rawDocument").isNull()).select("fileName")


def read_contents(spark: SparkSession, root: str, limit: int | None = None, glob: str | None = None) -> DataFrame:
    """The bytes of each file, nothing else."""
    return _contents(spark, root, limit, glob).select("content")


def clean_paths(files: DataFrame) -> DataFrame:
    """``filepath, rawDocument`` → the same with the base name and all line breaks as spaces."""
    return files.select(
        "filepath",
        text.base_name("filepath").alias("fileName"),
        text.line_breaks_to_spaces("rawDocument").alias("rawDocument"),
    )
