"""Books in chunks: the same sentences as from one row, whatever the chunks."""

import random

import pytest
from pyspark.errors import PySparkException

from tomegauge.operators.sentences import chunk_books, chunked_sentence_table, sentence_table, split_books, split_chunks
from tomegauge.plans.load import load_books
from tomegauge.schemas import BOOKS
from tomegauge.sources import books, tables

NAMES = ["Dr.", "e.g."]


def invented(draw, n):
    parts = ["One", "two", ".", "!?", '."', ")", " ", " ", "  ", "\t", " \n ", "Dr. ", "e.g. ", "é漢", "'", "] "]
    return "".join(draw.choice(parts) for _ in range(n))


@pytest.fixture(scope="module")
def shelf(spark):
    draw = random.Random(2)
    rows = [(f"b{k}", invented(draw, draw.randrange(60))) for k in range(300)]
    rows += [("blank", " \n "), ("empty", ""), ("null", None), ("open", "no end at all " * 30), ("ends", "A. " * 50), ("gap", "One." + " " * 50 + "two" + " " * 50 + ".")]
    return spark.createDataFrame(rows, BOOKS)


@pytest.mark.parametrize("size", [1, 2, 3, 5, 8, 20, 100, 1000])
@pytest.mark.parametrize("names", [[], NAMES])
def test_chunks_give_the_sentences_of_the_book(shelf, size, names):
    whole = sorted(map(tuple, split_books(shelf, names).collect()))
    found = sorted(map(tuple, split_chunks(chunk_books(shelf, size), names).collect()))
    assert found == whole


def test_chunks_make_up_the_text(shelf):
    chunks = {}
    for row in sorted(chunk_books(shelf, 7).collect(), key=lambda r: r.chunk):
        chunks[row.fileName] = chunks.get(row.fileName, "") + row.rawDocument
    assert chunks == {r.fileName: r.rawDocument for r in shelf.collect() if r.rawDocument}


def test_abbreviations_with_white_space_are_refused(shelf):
    with pytest.raises(ValueError, match="white space"):
        split_chunks(chunk_books(shelf, 9), ["et al."])


def test_large_files_are_read_by_many_tasks(spark, tmp_path):
    draw = random.Random(5)
    root = tmp_path / "txt"
    root.mkdir()
    text = "\n".join(invented(draw, 12) for _ in range(20_000)) + "\r\n\n"
    (root / "a +[b] é%20.txt").write_bytes(text.encode())
    (root / "small.txt").write_bytes(b"One. Two.")
    whole = sentence_table(books.read_books(spark, str(root)))
    expected = sorted(map(tuple, whole.collect()))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        path = books.large_files(books.index(spark, str(root)), 1000)
        chunks = books.read_chunks(spark, str(root), path, lines=500)
        assert len(path) == 1 and chunks.select("chunk.start").distinct().count() > 8
        found = chunked_sentence_table(chunks).unionByName(whole.where("fileName = 'txt/small.txt'"))
        assert sorted(map(tuple, found.collect())) == expected
        load_books(spark, str(root), str(tmp_path / "table"), buckets=4, large=1000)
        assert sorted(map(tuple, tables.read_sentences(spark, str(tmp_path / "table")).collect())) == expected
        (root / "bad.txt").write_bytes(b"fine line.\nbad \xff line.\nlast." + b"x" * 2000)
        with pytest.raises(PySparkException):
            books.read_chunks(spark, str(root), [str(root / "bad.txt")]).collect()
        lenient = books.read_chunks(spark, str(root), [str(root / "bad.txt")], strict=False)
        assert lenient.first().rawDocument.startswith("fine line.  last.x")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_stored_listings_read_large_files_by_blocks(spark, tmp_path, monkeypatch):
    draw = random.Random(6)
    root = tmp_path / "txt"
    root.mkdir()
    text = "\n".join(invented(draw, 12) for _ in range(5_000)) + "\r\n\n"
    (root / "a +[b] é%20.txt").write_bytes(text.encode())
    (root / "small.txt").write_bytes(b"One. Two.")
    (root / "line.txt").write_bytes(b"No end of line. " * 400)
    (root / "none.txt").write_bytes(b"")
    expected = sorted(map(tuple, sentence_table(books.read_books(spark, str(root))).collect()))
    monkeypatch.setattr(books, "FEW", 0)
    monkeypatch.setattr(books, "BATCH_BYTES", 200)
    monkeypatch.setattr(books, "TASK_BYTES", 3000)
    long = books.large_files(books.index(spark, str(root)), 1000)
    chunks = books.read_chunks(spark, str(root), long, lines=50)
    assert long.count() == 2 and chunks.select("chunk.start").distinct().count() > 8
    load_books(spark, str(root), str(tmp_path / "table"), buckets=4, large=1000)
    assert sorted(map(tuple, tables.read_sentences(spark, str(tmp_path / "table")).collect())) == expected
    (root / "bad.txt").write_bytes(b"fine line.\nbad \xff line.\nlast." + b"x" * 2000)
    bad = books.index(spark, str(root)).where("path like '%bad.txt'")
    with pytest.raises(PySparkException):
        books.read_chunks(spark, str(root), bad).collect()
    assert books.read_chunks(spark, str(root), bad, strict=False).first().rawDocument.startswith("fine line.  last.x")
