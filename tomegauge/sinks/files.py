"""Plain files. Each write replaces what the folder held."""

import os
import re
import shutil
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tomegauge.session import spread

#: The folder of a row without a key, as Spark names it.
NO_KEY = "__HIVE_DEFAULT_PARTITION__"

#: Files of a folder where a task writes many: few folders to make and to list, and enough of them to share out.
FOLDER_FILES = 2000


def write_lines(rows: DataFrame, path: str) -> None:
    """One string column as lines of text."""
    rows.write.mode("overwrite").text(path)


def write_json(rows: DataFrame, path: str) -> None:
    """Rows as JSON lines."""
    rows.write.mode("overwrite").json(path)


def write_lexicon(lexicon: DataFrame, path: str, distinct: bool = False) -> None:
    """``word,label`` lines. A second run replaces the first instead of doubling it."""
    if distinct:
        lexicon = lexicon.dropDuplicates(["word", "label"])
    lexicon.select("word", "label").write.mode("overwrite").csv(path)


def reset_table(spark: SparkSession, path: str, schema: StructType) -> None:
    """An empty table in the place of whatever was there, made if absent."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def _mounted(path: str) -> str:
    """The path by which a task opens a folder that Spark knows by ``path``, whether or not there is one."""
    return re.sub(r"\Afile:(//[^/]*)?", "", path)


def _files_of(folder: str, key: str):
    """Writes the rows of a task, sorted by key: a file for each key, in place once it is whole."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not os.path.isdir(folder):
            raise FileNotFoundError(f"{folder} is not shared with this executor")
        task = TaskContext.get()
        name, attempt = f"part-{task.partitionId():05d}.txt", f".{task.taskAttemptId()}"
        last, file, count = None, None, 0

        def close():
            file.close()
            os.replace(file.name, os.path.join(last, name))

        for batch in batches:
            for at, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                home = os.path.join(folder, f"{key}={NO_KEY if at is None else at}")
                if home != last:
                    if file is not None:
                        close()
                    os.makedirs(home, exist_ok=True)
                    last, file, count = home, open(os.path.join(home, attempt), "wb"), count + 1
                file.write((text.as_py() or b"") + b"\n")
        if file is not None:
            close()
        yield pa.RecordBatch.from_pydict({"files": pa.array([count], pa.int64())})

    return write


def _write_by_spark(rows: DataFrame, path: str, key: str) -> None:
    by_tasks = rows.write.partitionBy(key).option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    by_tasks.mode("append").text(path)


def write_text_files(rows: DataFrame, path: str, key: str, value: str) -> None:
    """A text file in a folder ``key=...`` for each value of an integer key, as ``partitionBy(key).text`` lays them out.

    Into a folder that is mounted the tasks write the files themselves, as Hadoop's local file
    system starts a process for every folder, file and checksum that it makes. On other stores Spark's writer
    does it, and the tasks put their files in place instead of the driver.
    """
    rows = rows.select(key, value)
    rows.where(F.lit(False)).write.partitionBy(key).text(path)
    folder = _mounted(path)
    if os.path.isdir(folder):
        sorted_ = rows.select(key, F.col(value).cast("binary")).sortWithinPartitions(key)
        sorted_.mapInArrow(_files_of(folder, key), "files long").agg(F.sum("files")).first()
    else:
        _write_by_spark(rows, path, key)


def _folders_of(folder: str, key: str, most: int):
    """Writes the rows of a task, sorted by file name: folders of at most ``most`` files, each in place once it is whole."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not os.path.isdir(folder):
            raise FileNotFoundError(f"{folder} is not shared with this executor")
        task = TaskContext.get()
        attempt = os.path.join(folder, f".{task.taskAttemptId()}")
        last, file, count = None, None, 0

        def settle():
            home = os.path.join(folder, f"part-{task.partitionId():05d}-{(count - 1) // most:06d}")
            try:
                os.rename(attempt, home)
            except OSError:
                # An attempt before this one, of the same rows, has put it there.
                if not os.path.isdir(home):
                    raise
                shutil.rmtree(attempt)

        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if name != last:
                    if file is not None:
                        file.close()
                        if count % most == 0:
                            settle()
                    if count % most == 0:
                        os.mkdir(attempt)
                    last, file, count = name, open(os.path.join(attempt, f"{key}={name}txt"), "wb"), count + 1
                file.write((text.as_py() or b"") + b"\n")
        if file is not None:
            file.close()
            settle()
        yield pa.RecordBatch.from_pydict({"files": pa.array([count], pa.int64())})

    return write


def write_listed_files(rows: DataFrame, path: str, key: str, value: str, most: int = FOLDER_FILES) -> None:
    """A text file ``key=....txt`` for each value of an integer key, many to a folder; their paths come in the order of these names.

    The rows are dealt out by ranges of the names, so each task writes folders of its own and neither the keys nor
    their number decide how many files a folder has. A folder for each file costs as much as the file, when it is written and
    when it is listed. On stores that are not mounted Spark's writer makes such folders, ``key=.../``; paths have the same order.
    """
    rows = rows.select(key, value)
    rows.where(F.lit(False)).write.partitionBy(key).text(path)
    folder = _mounted(path)
    if not os.path.isdir(folder):
        _write_by_spark(spread(rows, key), path, key)
        return
    name = F.concat(F.coalesce(F.col(key).cast("string"), F.lit(NO_KEY)), F.lit("."))
    named = rows.select(name.alias("name"), F.col(value).cast("binary"))
    dealt = named.repartitionByRange("name").sortWithinPartitions("name")
    dealt.mapInArrow(_folders_of(folder, key, most), "files long").agg(F.sum("files")).first()
