"""The batch load: book files to the stored sentence table, its totals and its manifest."""

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tomegauge.functions import text
from tomegauge.operators.sentences import chunked_sentence_table, sentence_table
from tomegauge.sinks import keyed, totals
from tomegauge.sources import books, manifest

KEY = ["fileName", "position"]

#: Files of one step of an incremental load. Where the driver holds the listing, it holds their addresses beside it.
STEP = 50_000

#: Bytes of a file above which it is read in chunks, by many tasks.
LARGE = 64 << 20


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException:
        return False
    return True


def _sentences(
    spark: SparkSession, root: str, files: DataFrame, paths: list[str] | DataFrame | None, strict: bool, min_syllables: int,
    abbreviations: Sequence[str], large: int,
) -> DataFrame:
    """The sentence table of an index of files; those above ``large`` bytes, which are at ``paths``, are cut in chunks."""
    some = paths is not None and (isinstance(paths, DataFrame) or len(paths) > 0)
    whole = files.where(F.col("_metadata.file_size") <= large) if some else files
    rows = sentence_table(books.read_books(spark, root, strict=strict, files=whole), min_syllables, abbreviations)
    if not some:
        return rows
    chunks = books.read_chunks(spark, root, paths, strict)
    return rows.unionByName(chunked_sentence_table(chunks, min_syllables, abbreviations))


def _load(spark: SparkSession, path: str, rows: DataFrame, names: DataFrame, buckets: int | None, size: int = totals.CHUNK) -> None:
    table = spark.read.parquet(path) if _exists(spark, path) else None
    if table is None or table.isEmpty():
        keyed.create_keyed(rows, path, KEY, buckets or keyed.BUCKETS, unique=True)
        touched = None
    else:
        there = table.select("buckets").first().buckets
        if buckets not in (None, there):
            raise ValueError(f"{path} has {there} buckets")
        # Of added books the totals are counted from their rows alone, so that a load in steps reads no row twice for them.
        kept = all(_exists(spark, home) for home in (totals.totals_path(path), totals.running_path(path)))
        added = keyed.add_keyed(spark, path, rows, KEY, names, unique=True) if kept else None
        if added is not None:
            totals.add(spark, path, added, size)
            return
        touched = keyed.merge_keyed(spark, path, rows, KEY, names, unique=True)
    totals.refresh(spark, path, touched if _exists(spark, totals.totals_path(path)) else None, size)


def load_books(
    spark: SparkSession,
    root: str,
    path: str,
    limit: int | None = None,
    glob: str | None = "*.txt",
    strict: bool = True,
    min_syllables: int = text.MULTI_SYLLABLE_FROM,
    abbreviations: Sequence[str] = (),
    buckets: int | None = None,
    after: str | None = None,
    large: int = LARGE,
) -> str | None:
    """Read the first ``limit`` files below ``root`` and load their sentences into the table at ``path``.

    The table is made if absent or without rows; otherwise each book read replaces what
    the table held of it, so a load may be repeated and a changed book is
    loaded whole. ``buckets`` is for a new table; another number than that of the table is refused.
    The totals beside the table (``sinks.totals``) are kept up to date. Files above ``large`` bytes are read in
    chunks by several tasks.

    Gives the address of the last file read, None if there was none. ``after`` that
    address the next load goes on. The folder is listed once. In a mounted folder the driver holds nothing per file;
    in other stores it holds the listing, so there a library of many million files is loaded folder by folder.
    """
    files = books.index(spark, root, glob)
    with books.small_files(spark):
        last = books.last_file(spark, root, limit, glob, after, files)
        if last is None:
            return None
        wanted = books.address() <= last
        files = files.where(wanted if after is None else wanted & (books.address() > after))
        # Sentences are numbered within their book, so their keys are unique. The names alone come from the listing.
        rows = _sentences(spark, root, files, books.large_files(files, large), strict, min_syllables, abbreviations, large)
        _load(spark, path, rows, books.listing(files, root).select("fileName"), buckets)
    return last


def manifest_path(path: str) -> str:
    return f"{path.rstrip('/')}_files"


def _between(unchanged: DataFrame, rows: list) -> list[str] | None:
    """Addresses of unchanged files among those to load, in order; None if they are more than these."""
    among = unchanged.select("address").where(F.col("address").between(rows[0].address, rows[-1].address))
    found = among.limit(len(rows) + 1).collect()
    return sorted(row.address for row in found) if len(found) <= len(rows) else None


def _wanted(part: list[str], stay: list[str] | None) -> Column:
    """The files of a step, as bounds and the shorter list of those in it and those to leave out.

    All files between two that are loaded are either loaded or unchanged, so where none is unchanged the bounds tell the
    step. A list of ten thousands takes the planner longer than the files take to read.
    """
    bounds = books.address().between(part[0], part[-1])
    if stay is not None:
        out = stay[bisect_left(stay, part[0]) : bisect_right(stay, part[-1])]
        if len(out) < len(part):
            return bounds & ~books.address().isin(out) if out else bounds
    return bounds & books.address().isin(part)


def load_new_books(
    spark: SparkSession,
    root: str,
    path: str,
    limit: int | None = None,
    glob: str | None = "*.txt",
    strict: bool = True,
    min_syllables: int = text.MULTI_SYLLABLE_FROM,
    abbreviations: Sequence[str] = (),
    buckets: int | None = None,
    drop_gone: bool = False,
    step: int = STEP,
    large: int = LARGE,
) -> int:
    """Load the files below ``root`` that are new or changed since they were loaded, at most ``limit``; gives their number.

    ``<path>_files`` is the manifest: address, length and time of every file loaded. The folder is
    listed once, the listing is joined with the manifest, and only what is left is opened. Files go in by address,
    ``step`` at a time; each step is added to the manifest once its sentences are in the table, so a load that is broken off
    goes on from the last step. ``drop_gone`` takes the books of files no longer there out of the table.
    """
    files = books.index(spark, root, glob)
    with books.small_files(spark):
        listed = books.listing(files, root)
        home = manifest_path(path)
        first = not _exists(spark, home)
        known = spark.createDataFrame([], manifest.FILES) if first else manifest.known_files(spark, home)
        load = 1 if first else manifest.last_load(spark, home) + 1
        fresh = manifest.changed_files(listed, known)
        gone = manifest.gone_files(listed, known)
        if books.is_stored(files):
            steps = _stored_steps(files, fresh, limit, step)
            return _load_steps(spark, root, path, steps, home, load, gone if drop_gone and not first else None, strict, min_syllables, abbreviations, buckets, large)
        # No more than the listing that the driver holds as it is.
        fresh = fresh.orderBy("address") if limit is None else fresh.orderBy("address").limit(limit)
        rows = fresh.collect()
        stay = [] if first or not rows else _between(manifest.unchanged_files(listed, known), rows)
        long = books.large_addresses(files, large) if rows else {}
        return _load_steps(
            spark, root, path, _named_steps(spark, files, rows, stay, long, step), home, load,
            gone if drop_gone and not first else None, strict, min_syllables, abbreviations, buckets, large,
        )


def _named_steps(spark: SparkSession, files: DataFrame, rows: list, stay: list[str] | None, long: dict[str, str], step: int) -> Iterator[tuple]:
    """Of each step the files, the paths of the large ones, the rows of the manifest less their load, and their number."""
    schema = "address string, fileName string, length long, modified timestamp"
    for at in range(0, len(rows), step):
        part = rows[at : at + step]
        some = files.where(_wanted([row.address for row in part], stay))
        yield some, [long[row.address] for row in part if row.address in long], spark.createDataFrame(part, schema), len(part)


def _stored_steps(files: DataFrame, fresh: DataFrame, limit: int | None, step: int) -> Iterator[tuple]:
    """The same of a stored listing. The files to load are stored once more, in order, and a step is a range of their places."""
    paths = files.select(books.address().alias("address"), "path")
    ranked = books.ranked(fresh.join(paths, "address"), "fileName", "path", "length", "modified")
    count = ranked.count()
    count = count if limit is None else min(count, limit)
    for at in range(0, count, step):
        end = min(at + step, count)
        part = ranked.where(F.col("place").between(at, end - 1))
        some = books.as_index(part)
        yield some, some, part.select("address", "fileName", "length", "modified"), end - at


def _load_steps(
    spark: SparkSession, root: str, path: str, steps: Iterator[tuple], home: str, load: int, gone: DataFrame | None,
    strict: bool, min_syllables: int, abbreviations: Sequence[str], buckets: int | None, large: int,
) -> int:
    """Load step by step, then take out the books of files found ``gone``; gives the number of files loaded."""
    count = 0
    for some, long, read, number in steps:
        paths = books.large_files(some, large) if isinstance(long, DataFrame) else long
        sentences = _sentences(spark, root, some, paths, strict, min_syllables, abbreviations, large)
        _load(spark, path, sentences, read.select("fileName"), buckets)
        manifest.record_files(read, home, load)
        count += number
    if gone is not None and not gone.isEmpty():
        names = gone.select("fileName")
        none = spark.read.parquet(path).drop("buckets", "bucket").where(F.lit(False))
        _load(spark, path, none, names, None)
        manifest.record_files(gone, home, load, gone=True)
    return count
