"""File sources, sinks and keyed tables, each in a fresh folder."""

import json
import os
import random
import subprocess
import sys
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.ml import Pipeline
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tomegauge.operators import documents, passages, search
from tomegauge.plans import landing
from tomegauge.plans.load import load_books, load_new_books
from tomegauge.schemas import SENTENCES
from tomegauge.sinks import files, keyed, totals
from tomegauge.sources import books, dictionaries, tables
from tomegauge.stages import readability_stages, sentence_splitter, syllable_counter, tokenizer

KEY = ["fileName", "position"]


@pytest.fixture
def shelf(tmp_path):
    root = tmp_path / "txt"
    root.mkdir()
    for name, content in [("1.txt", b"One.\nTwo.\n"), ("10.txt", "Été.".encode()), ("2 b.txt", b"Three. "), ("notes.md", b"x")]:
        (root / name).write_bytes(content)
    return root


def test_listing(spark, shelf):
    listed = books.list_books(spark, str(shelf), glob="*.txt").orderBy("fileName").collect()
    assert [(r.fileName, r.length) for r in listed] == [("txt/1.txt", 10), ("txt/10.txt", 6), ("txt/2 b.txt", 7)]
    assert books.list_books(spark, str(shelf)).count() == 4
    assert [r.fileName for r in books.list_books(spark, str(shelf), 1).collect()] == ["txt/1.txt"]


def test_whole_files(spark, shelf):
    rows = {r.fileName: r.rawDocument for r in books.read_books(spark, str(shelf), glob="*.txt").collect()}
    assert rows == {"txt/1.txt": "One. Two. ", "txt/10.txt": "Été.", "txt/2 b.txt": "Three. "}
    assert books.read_books(spark, str(shelf), 2, "*.txt").count() == 2
    contents = {bytes(r.content) for r in books.read_contents(spark, str(shelf), glob="*.txt").collect()}
    assert b"One.\nTwo.\n" in contents


def test_limited_read_opens_only_those_files(spark, shelf):
    assert books.read_books(spark, str(shelf), 1, "*.txt").rdd.getNumPartitions() < 3


def test_broken_text_fails_or_is_set_aside(spark, shelf):
    (shelf / "3.txt").write_bytes(b"bad \xff\xfe bytes")
    with pytest.raises(PySparkException):
        books.read_books(spark, str(shelf), glob="*.txt").collect()
    lenient = books.read_books(spark, str(shelf), glob="*.txt", strict=False)
    assert [r.fileName for r in books.broken_books(lenient).collect()] == ["txt/3.txt"]
    assert lenient.count() == 4


def test_word_lists_are_latin_and_keep_blank_lines(spark, tmp_path):
    path = tmp_path / "negative-words.txt"
    path.write_bytes("; a comment\nna\u00efve\n\n  faux \xa0\n\"quote,d\n".encode("iso-8859-1"))
    words = [r.word for r in dictionaries.read_word_list(spark, str(path)).collect()]
    assert words == ["; a comment", "naïve", "", "faux", '"quote,d']


def test_lexicon_does_not_grow(spark, tmp_path):
    lexicon = dictionaries.build_lexicon(
        dictionaries.given_words(spark, ["bad", "odd"]), dictionaries.given_words(spark, ["good", "odd"])
    )
    path = str(tmp_path / "lexicon")
    for _ in range(2):
        files.write_lexicon(lexicon, path)
    stored = sorted((r.word, r.label) for r in dictionaries.read_lexicon(spark, path).collect())
    assert stored == [("bad", "negative"), ("good", "positive"), ("odd", "negative"), ("odd", "positive")]
    files.write_lexicon(lexicon.unionByName(lexicon), path, distinct=True)
    assert dictionaries.read_lexicon(spark, path).count() == 4


def test_lemmas(spark, tmp_path):
    path = tmp_path / "lemmas.txt"
    path.write_text("be -> am\tare\tis\ngo->goes\twent\n\nbroken line\n")
    lemmas = sorted((r.form, r.lemma) for r in dictionaries.read_lemmas(spark, str(path)).collect())
    assert lemmas == [("am", "be"), ("are", "be"), ("goes", "go"), ("is", "be"), ("went", "go")]


def test_json_documents_come_back(spark, sentences, tmp_path):
    path = str(tmp_path / "json")
    documents.index_documents(sentences).write.parquet(path)
    back = tables.read_index_documents(spark, path).drop("sentence_id")
    assert back.exceptAll(sentences).count() == 0 == sentences.exceptAll(back).count()
    first = json.loads(spark.read.parquet(path).first().value)
    assert list(first)[0] == "sentence_id"


def small(spark, rows):
    return spark.createDataFrame([(n, p, t, 0, c, 0) for n, p, t, c in rows], SENTENCES)


def test_loading_twice_equals_loading_once(spark, tmp_path):
    path = str(tmp_path / "table")
    first = small(spark, [(f"b{i}", p, "old", 0) for i in range(20) for p in range(3)])
    second = small(spark, [("b1", 1, "new", 5), ("b1", 9, "new", 5), ("c", 0, "new", 5)])
    keyed.create_keyed(first, path, KEY, 4)
    for _ in range(2):
        keyed.merge_keyed(spark, path, second, KEY)
        table = tables.read_sentences(spark, path)
        assert table.count() == 62
        assert table.groupBy(*KEY).count().where("count > 1").count() == 0
        assert table.where("sentenceText = 'new'").count() == 3
    expected = keyed.upsert(first, second, KEY)
    assert expected.exceptAll(table).count() == 0 == table.exceptAll(expected).count()


def test_a_merge_shuffles_only_the_books_it_may_change(spark, physical, tmp_path, monkeypatch):
    path, parts, writes = str(tmp_path / "table"), [], []
    first = small(spark, [(f"b{i}", p, "old", 0) for i in range(200) for p in range(3)] + [(None, 0, "old", 0)])
    second = small(spark, [("b1", 1, "new", 5), ("b1", 9, "new", 5), ("c", 0, "new", 5), (None, 0, "new", 5)])
    keyed.create_keyed(first, path, KEY, 4)
    apart, write = keyed._apart, keyed.write_bucketed

    def seen(*args):
        stay, near = apart(*args)
        parts.append((physical(stay), stay.count(), near.count()))
        return stay, near

    monkeypatch.setattr(keyed, "_apart", seen)
    monkeypatch.setattr(keyed, "write_bucketed", lambda rows, *a, **k: writes.append((a, k)) or write(rows, *a, **k))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        keyed.merge_keyed(spark, path, second, KEY)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    ((plan, stay, near),) = parts
    assert "hashpartitioning" not in plan and near == 3 and stay > 100
    assert len(writes) == 2 and writes[1][0][2:] == ("dynamic", True)
    table = tables.read_sentences(spark, path)
    # Rows without a name never meet, so both stay, as before.
    nameless = first.where("fileName is null").unionByName(second.where("fileName is null"))
    expected = keyed.upsert(first.where("fileName is not null"), second.where("fileName is not null"), KEY).unionByName(nameless)
    assert sorted(map(str, table.collect())) == sorted(map(str, expected.collect()))


def test_merge_leaves_other_buckets_alone(spark, tmp_path):
    path = tmp_path / "table"
    keyed.create_keyed(small(spark, [(f"b{i}", 0, "old", 0) for i in range(40)]), str(path), KEY, 8)
    before = {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}
    keyed.merge_keyed(spark, str(path), small(spark, [("b1", 0, "new", 0)]), KEY)
    after = {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}
    kept = {f for f in before if after.get(f) == before[f]}
    assert {f.parent for f in before if f not in kept} == {f.parent for f in after if f not in kept}
    assert len({f.parent for f in after if f not in kept}) == 1
    assert tables.read_book(spark, str(path), "b1").first().sentenceText == "new"


def test_a_broken_off_replacement_may_be_repeated(spark, tmp_path):
    path, merged = str(tmp_path / "table"), str(tmp_path / "merged")
    keyed.create_keyed(small(spark, [("a", 0, "old", 0), ("b", 0, "old", 0)]), path, KEY, 2)
    table = spark.read.parquet(path)
    touched = [r.bucket for r in table.select("bucket").distinct().collect()]
    table.withColumn("sentenceText", F.lit("new")).where("fileName = 'a'").write.parquet(merged)
    for _ in range(2):
        keyed.replace_buckets(spark, path, spark.read.parquet(merged), KEY, 2, touched)
        assert [(r.fileName, r.sentenceText) for r in tables.read_sentences(spark, path).collect()] == [("a", "new")]
        assert spark.read.parquet(path).schema == table.schema


def test_a_load_replaces_whole_books(spark, tmp_path):
    path = str(tmp_path / "table")
    keyed.create_keyed(small(spark, [("a", k, "old", 3) for k in range(3)] + [("b", 0, "old", 1)]), path, KEY, 2)
    names = spark.createDataFrame([("a",)], "fileName string")
    keyed.merge_keyed(spark, path, small(spark, [("a", 0, "new", 1)]), KEY, names)
    assert sorted((r.fileName, r.sentenceText) for r in tables.read_sentences(spark, path).collect()) == [("a", "new"), ("b", "old")]
    keyed.merge_keyed(spark, path, small(spark, []), KEY, names)
    assert [r.fileName for r in tables.read_sentences(spark, path).collect()] == ["b"]
    keyed.merge_keyed(spark, path, small(spark, []), KEY, spark.createDataFrame([("b",)], "fileName string"))
    assert tables.read_sentences(spark, path).count() == 0


def test_reset_then_load_and_repeats_in_a_first_load(spark, tmp_path):
    path = str(tmp_path / "table")
    files.reset_table(spark, path, SENTENCES)
    keyed.merge_keyed(spark, path, small(spark, [("a", 0, "one", 0), ("a", 0, "two", 0), ("b", 0, "one", 0)]), KEY)
    assert sorted(r.sentenceText for r in tables.read_sentences(spark, path).collect()) == ["one", "two"]
    spark.range(3).write.parquet(str(tmp_path / "plain"))
    with pytest.raises(ValueError, match="keyed"):
        keyed.merge_keyed(spark, str(tmp_path / "plain"), spark.range(3), ["id"])


def test_one_key_with_very_many_copies(spark):
    batch = spark.range(20000).select(
        F.lit("hot").alias("fileName"), F.lit(0).alias("position"), F.col("id").alias("v")
    )
    old = spark.createDataFrame([("hot", 0, -1), ("cold", 0, -1)], batch.schema)
    assert sorted(map(tuple, keyed.upsert(old, batch, KEY).collect())) == [("cold", 0, -1), ("hot", 0, 19999)]


def test_hot_bucket_is_written_by_several_tasks(spark, tmp_path):
    path = tmp_path / "table"
    rows = spark.range(200000).select(
        F.lit("hot").alias("fileName"), F.col("id").cast("int").alias("position"), F.sha2(F.col("id").cast("string"), 512).alias("t")
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        keyed.create_keyed(rows, str(path), KEY, 4)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list(path.rglob("*.parquet"))) > 3
    assert spark.read.parquet(str(path)).count() == 200000


def test_load_in_batches(spark, shelf, tmp_path):
    path = str(tmp_path / "sentences")
    load_books(spark, str(shelf), path, limit=1, buckets=4)
    assert {r.fileName for r in tables.read_sentences(spark, path).collect()} == {"txt/1.txt"}
    (shelf / "1.txt").write_bytes(b"Uno.")
    for _ in range(2):
        load_books(spark, str(shelf), path)
        found = sorted((r.fileName, r.position, r.sentenceText) for r in tables.read_sentences(spark, path).collect())
        assert found == [("txt/1.txt", 0, "Uno."), ("txt/10.txt", 0, "Été."), ("txt/2 b.txt", 0, "Three.")]
    with pytest.raises(ValueError, match="buckets"):
        load_books(spark, str(shelf), path, buckets=5)


def test_loads_go_on_where_the_last_one_ended(spark, shelf, tmp_path):
    path, last, steps = str(tmp_path / "sentences"), None, []
    while (last := load_books(spark, str(shelf), path, limit=1, after=last)) is not None:
        steps.append(tables.read_sentences(spark, path).select("fileName").distinct().count())
    assert steps == [1, 2, 3]


def test_manifest_loads_open_only_new_or_changed_files(spark, shelf, tmp_path, monkeypatch):
    path, listed, read = str(tmp_path / "sentences"), [], []
    index, whole = books.index, books.read_books
    monkeypatch.setattr(books, "index", lambda *a, **k: listed.append(1) or index(*a, **k))
    monkeypatch.setattr(books, "read_books", lambda *a, **k: read.append(frame := whole(*a, **k)) or frame)

    def load(**options):
        listed.clear(), read.clear()
        count = load_new_books(spark, str(shelf), path, buckets=4, **options)
        assert len(listed) == 1
        opened = sorted(r.fileName for frame in read for r in frame.select("fileName").collect())
        assert len(opened) == count and all(frame.rdd.getNumPartitions() <= max(1, count) for frame in read)
        there = sorted((r.fileName, r.sentenceText) for r in tables.read_sentences(spark, path).collect())
        return opened, there

    assert load(limit=1) == (["txt/1.txt"], [("txt/1.txt", "One."), ("txt/1.txt", "Two.")])
    before = os.stat(shelf / "1.txt")
    (shelf / "1.txt").write_bytes(b"xxx.\nyyy.\n")  # the same length and time: taken for unchanged
    os.utime(shelf / "1.txt", ns=(before.st_atime_ns, before.st_mtime_ns))
    opened, there = load(step=1)
    assert opened == ["txt/10.txt", "txt/2 b.txt"] and len(read) == 2 and there[0] == ("txt/1.txt", "One.")
    assert load() == ([], there)
    (shelf / "10.txt").write_bytes(b"New. Newer. Newest.")
    opened, there = load()
    assert opened == ["txt/10.txt"] and [t for n, t in there if n == "txt/10.txt"] == ["New.", "Newer.", "Newest."]
    (shelf / "2 b.txt").unlink()
    assert load()[1] == there
    assert load(drop_gone=True) == ([], [row for row in there if row[0] != "txt/2 b.txt"])
    kept = {r.fileName: r.doc_count for r in spark.read.parquet(totals.totals_path(path)).collect()}
    assert kept == {"txt/1.txt": 2, "txt/10.txt": 3}
    (shelf / "2 b.txt").write_bytes(b"Back.")
    assert load()[0] == ["txt/2 b.txt"]


def test_files_of_rows_are_those_of_spark(spark, tmp_path):
    rows = [(1, "a\nb"), (1, "c"), (-2, "\u00e9 \u6f22"), (3, None), (None, "no key"), (4, "")]
    raw = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    home, plain = tmp_path / "files a", tmp_path / "plain"
    files.write_text_files(raw, str(home), "doc_id", "text")
    raw.write.partitionBy("doc_id").text(str(plain))

    def contents(root):
        return sorted((str(f.parent.relative_to(root)), f.read_bytes()) for f in root.rglob("*.txt"))

    assert contents(home) == contents(plain) and len(contents(home)) == 5
    # No checksums beside the files, each of which costs a process, and nothing unfinished.
    assert not [f for f in home.rglob("*") if f.parent != home and f.name.startswith(".")]
    files.write_text_files(raw.where("false"), str(tmp_path / "none"), "doc_id", "text")
    assert books.list_books(spark, str(tmp_path / "none"), glob="*.txt").count() == 0
    files.write_text_files(raw, f"file://{tmp_path}/by uri", "doc_id", "text")
    assert contents(tmp_path / "by uri") == contents(plain)


def test_book_files_come_many_to_a_folder_in_the_order_of_their_names(spark, tmp_path):
    home = tmp_path / "txt"
    rows = [(k, f"Text {k}.") for k in range(130)] + [(7, "More."), (None, "Nameless."), (1000, None)]
    raw = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    files.write_listed_files(raw, str(home), "doc_id", "text", most=4)
    found = sorted(str(f.relative_to(home)) for f in home.rglob("*.txt"))
    assert not [f for f in home.iterdir() if f.name.startswith(".") and f.is_dir()]
    names = [f.rsplit("/", 1)[1] for f in found]
    assert names == sorted(f"doc_id={'__HIVE_DEFAULT_PARTITION__' if k is None else k}.txt" for k in {k for k, _ in rows})
    folders = [f.rsplit("/", 1)[0] for f in found]
    assert max(map(folders.count, folders)) == 4 and len(set(folders)) <= 132 // 4 + 16
    texts = {f.rsplit("/", 1)[1]: (home / f).read_text() for f in found}
    assert texts["doc_id=12.txt"] == "Text 12.\n" and texts["doc_id=1000.txt"] == "\n"
    assert sorted(texts["doc_id=7.txt"].splitlines()) == ["More.", "Text 7."]
    first = books.list_books(spark, str(home), 3, "*.txt").select(landing.document_id(), "length").collect()
    assert sorted(map(tuple, first)) == [(0, 8), (1, 8), (10, 9)]


def test_an_attempt_finds_the_folders_of_the_one_before_it(tmp_path, monkeypatch):
    batch = files.pa.record_batch({"name": [f"{k}." for k in range(5)], "text": [b"Text."] * 5})
    for attempt in (1, 2):
        task = SimpleNamespace(partitionId=lambda: 3, taskAttemptId=lambda at=attempt: at)
        monkeypatch.setattr(files, "TaskContext", SimpleNamespace(get=lambda task=task: task))
        assert [b.to_pydict() for b in files._folders_of(str(tmp_path), "k", 2)([batch])] == [{"files": [5]}]
        assert sorted(f.name for f in tmp_path.iterdir()) == [f"part-00003-00000{k}" for k in range(3)]
        assert sorted(f.name for f in tmp_path.rglob("*.txt")) == [f"k={k}.txt" for k in range(5)]


def test_many_files_are_listed_by_few_tasks(spark, tmp_path):
    for k in range(1500):
        (tmp_path / f"{k}.txt").write_text("One. ")
    listed = books.list_books(spark, str(tmp_path), glob="*.txt")
    assert listed.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
    assert listed.count() == 1500 == listed.select("path").distinct().count()


def test_steps_of_a_load_name_no_more_files_than_needed(spark, tmp_path, monkeypatch):
    shelf, path = tmp_path / "txt", str(tmp_path / "table")
    shelf.mkdir()
    for k in range(40):
        (shelf / f"{k:02}.txt").write_text(f"Book {k}. End.")
    filters, real = [], books.read_books

    def seen(*args, files, **options):
        filters.append(files._jdf.queryExecution().optimizedPlan().toString())
        return real(*args, files=files, **options)

    monkeypatch.setattr(books, "read_books", seen)
    assert load_new_books(spark, str(shelf), path, 12, buckets=2) == 12
    assert load_new_books(spark, str(shelf), path, buckets=2, step=20) == 28
    assert len(filters) == 3 and not any("INSET" in f or " IN (" in f for f in filters)
    (shelf / "05.txt").write_text("Changed book.")
    for k in (3, 11, 41):
        (shelf / f"{k:02}.txt").write_text("Another one. Of three. Sentences.")
    assert load_new_books(spark, str(shelf), path, buckets=2) == 4
    there = tables.read_sentences(spark, path).groupBy("fileName").count().collect()
    assert {r[0]: r[1] for r in there} == {f"txt/{k:02}.txt": 2 for k in range(40)} | {"txt/05.txt": 1} | {f"txt/{k:02}.txt": 3 for k in (3, 11, 41)}
    kept = spark.read.parquet(totals.totals_path(path)).select("fileName", "doc_count").collect()
    assert {r[0]: r[1] for r in kept} == {r[0]: r[1] for r in there}


def test_steps_of_a_load_count_only_their_own_books(spark, tmp_path, monkeypatch):
    shelf, path, counted, tasks = tmp_path / "txt", str(tmp_path / "a table"), [], []
    shelf.mkdir()
    for k in range(500):
        (shelf / f"{k:03}.txt").write_text("Sentence of any book. " * (k % 3) or " ")
    refresh, whole = totals.refresh, books.read_books
    monkeypatch.setattr(totals, "refresh", lambda *a, **k: counted.append(1) or refresh(*a, **k))
    monkeypatch.setattr(books, "read_books", lambda *a, **k: tasks.append((frame := whole(*a, **k)).rdd.getNumPartitions()) or frame)

    def kept():
        table = spark.read.parquet(path)
        for rows, home in ((totals.totals_of(table), totals.totals_path(path)), (totals.running_of(table), totals.running_path(path))):
            there = spark.read.parquet(home).select(*rows.columns)
            assert sorted(map(str, there.collect())) == sorted(map(str, rows.collect()))

    before = spark.conf.get(books.OPEN_COST)
    assert load_new_books(spark, str(shelf), path, buckets=3, step=200) == 500
    # Small files come by hundreds a task, and only the first step counts a whole table.
    assert max(tasks) <= spark.sparkContext.defaultParallelism + 1 and len(counted) == 1
    assert spark.conf.get(books.OPEN_COST) == before
    kept()
    (shelf / "000.txt").write_text("Now it has one.")
    (shelf / "001.txt").write_text("Another.")
    (shelf / "new.txt").write_text("One more. " * 1500)
    assert load_new_books(spark, str(shelf), path) == 3
    kept()
    # Totals of a book that the table no longer holds, as a load leaves them that is broken off.
    keyed.merge_keyed(spark, path, spark.read.parquet(path).drop("buckets", "bucket").where("false"), KEY, spark.createDataFrame([("txt/new.txt",)], "fileName string"))
    (shelf / "new.txt").write_text("Shorter.")
    assert load_new_books(spark, str(shelf), path) == 1
    kept()


def test_books_new_to_a_table_are_added_to_it(spark, tmp_path):
    path = str(tmp_path / "table")
    first = spark.createDataFrame([("a", 0, "x"), ("b", 0, "x")], "fileName string, position int, text string")
    keyed.create_keyed(first, path, KEY, 2)
    before = {str(f): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}
    more = spark.createDataFrame([("c", 0, "y"), ("d", 0, "y"), ("d", 1, "y")], first.schema)
    touched = keyed.merge_keyed(spark, path, more, KEY, more.select("fileName"))
    after = {str(f): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}
    assert before.items() < after.items() and set(touched) <= {0, 1}
    assert sorted(r[:3] for r in spark.read.parquet(path).collect()) == [("a", 0, "x"), ("b", 0, "x"), ("c", 0, "y"), ("d", 0, "y"), ("d", 1, "y")]
    again = spark.createDataFrame([("d", 0, "z")], first.schema)
    keyed.merge_keyed(spark, path, again, KEY, again.select("fileName"))
    assert sorted(r[:3] for r in spark.read.parquet(path).collect()) == [("a", 0, "x"), ("b", 0, "x"), ("c", 0, "y"), ("d", 0, "z")]


def test_totals_of_a_table_that_loses_all_rows(spark, tmp_path):
    path = str(tmp_path / "table")
    keyed.create_keyed(small(spark, [("a", k, "t", 3) for k in range(5)]), path, KEY, 2)
    totals.refresh(spark, path, size=2)
    for rows in ([], [("a", 0, "t", 1)]):
        touched = keyed.merge_keyed(spark, path, small(spark, rows), KEY, spark.createDataFrame([("a",)], "fileName string"))
        totals.refresh(spark, path, touched, 2)
        found = [(r.fileName, r.doc_count, r.sum_multiSyllables) for r in spark.read.parquet(totals.totals_path(path)).collect()]
        assert found == [(n, 1, c) for n, _, _, c in rows]
        assert spark.read.parquet(totals.running_path(path)).count() == len(rows)


def test_passages_by_running_counts(spark, tmp_path):
    draw = random.Random(1)
    rows = [(f"b{b}", k, "t", draw.randrange(5)) for b, n in enumerate([1, 7, 8, 9, 40]) for k in range(n)]
    path = str(tmp_path / "table")
    keyed.create_keyed(small(spark, rows), path, KEY, 2)
    totals.refresh(spark, path, size=4)
    table, running = spark.read.parquet(path), spark.read.parquet(totals.running_path(path))
    for first, last in [(0, 0), (0, 3), (3, 4), (4, 7), (5, 6), (2, 33), (7, 7), (8, 100), (39, 39), (50, 60)]:
        expected = sorted(map(tuple, passages.passage_scores(table, first, last).collect()))
        assert sorted(map(tuple, passages.passage_scores_by_running(table, running, first, last, 4).collect())) == expected
        one = passages.passage_scores_by_running(table, running, first, last, 4, "b4")
        assert list(map(tuple, one.collect())) == [row for row in expected if row[0] == "b4"]


def test_stored_listings_are_those_of_spark(spark, tmp_path, monkeypatch):
    root = tmp_path / "a b" / "txt"
    for name in ("1.txt", "10.txt", "é 漢+&%20#?;=@.txt", "[x]{y}^`\"<>|~.txt", "no break.txt", "sub/_part=1/2 b.txt", "sub/deep/3.txt", ".hidden/4.txt",
                 "_hidden/5.txt", "_k=1.txt", "_6.txt", ".7.txt", "8.txt._COPYING_", "notes.md", "9.TXT", "empty.txt"):
        file = root / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(b"" if name == "empty.txt" else f"Text of {name}.\nMore.".encode())
    os.utime(root / "1.txt", ns=(10**18, 10**18 + 123_999_999))
    (root / "link.txt").symlink_to(root / "1.txt")
    (root / "nowhere.txt").symlink_to(root / "none")

    def seen(at, glob):
        files_ = books.index(spark, at, glob)
        stored.append(books.is_stored(files_))
        frames = [
            files_.select("path", books.address(), "length", "modificationTime"), books.list_books(spark, at, files=files_),
            books.list_books(spark, at, 3, files=files_), books.read_books(spark, at, files=files_), books.read_books(spark, at, 2, files=files_),
            books._contents(spark, at, None, None, order[1], order[4], files_).select("content"),
        ]
        lasts = [books.last_file(spark, at, limit, None, after, files_) for limit, after in ((None, None), (4, None), (1, order[2]), (99, order[2]), (2, order[-1]))]
        return [sorted(map(tuple, frame.collect())) for frame in frames] + lasts

    stored, roots = [], ((str(root), "*.txt"), (f"file://{root}", None), (str(root), "{1,10}.txt"))
    order = sorted(r[0] for r in books.index(spark, str(root), "*.txt").select(books.address()).collect())
    expected = [seen(*at) for at in roots]
    monkeypatch.setattr(books, "FEW", 0)
    for at, rows in zip(roots, expected, strict=True):
        for found, row in zip(seen(*at), rows, strict=True):
            assert found == row
    assert stored == [False] * 3 + [True, True, False]
    (root / "bad.txt").write_bytes(b"bad \xff")
    files_ = books.index(spark, str(root), "b*.txt")
    with pytest.raises(PySparkException):
        books.read_books(spark, str(root), files=files_).collect()
    assert [r.fileName for r in books.broken_books(books.read_books(spark, str(root), files=files_, strict=False)).collect()] == ["txt/bad.txt"]


def test_loads_hold_no_file_on_the_driver(spark, tmp_path, monkeypatch):
    shelf, loaded = tmp_path / "txt", []
    shelf.mkdir()
    for k in range(60):
        (shelf / f"{k:02}.txt").write_text(f"Book {k}. End." * (1 + k % 3))
    few, large = books.FEW, books.large_addresses
    monkeypatch.setattr(books, "large_addresses", lambda files, above: loaded.append(1) or large(files, above))
    monkeypatch.setattr(books, "TASK_FILES", 7)

    def load(kind, path):
        if kind == "manifest":
            assert [load_new_books(spark, str(shelf), path, limit, buckets=2, step=30, large=20) for limit in (5, None)] == [5, 55]
            (shelf / "05.txt").write_text("Changed book.")
            (shelf / "60.txt").write_text("New book.")
            (shelf / "07.txt").rename(shelf / "99.md")
            assert load_new_books(spark, str(shelf), path, drop_gone=True) == 2
            (shelf / "60.txt").unlink()
            (shelf / "99.md").rename(shelf / "07.txt")
            (shelf / "05.txt").write_text("Book 5. End." * 3)
            os.utime(shelf / "05.txt", ns=(10**18, 10**18))
        else:
            last = None
            for _ in range(2):
                last = load_books(spark, str(shelf), path, 31, buckets=2, after=last)
        kept = [tables.read_sentences(spark, path), spark.read.parquet(totals.totals_path(path))]
        if kind == "manifest":
            kept.append(spark.read.parquet(f"{path}_files").select("fileName", "length", "load"))
        return [sorted(map(str, frame.collect())) for frame in kept]

    expected = {kind: load(kind, str(tmp_path / kind)) for kind in ("manifest", "batches")}
    assert loaded and books.FEW == few
    monkeypatch.setattr(books, "FEW", 0)
    loaded.clear()
    for kind, rows in expected.items():
        assert load(kind, str(tmp_path / f"{kind} by tasks")) == rows
    assert not loaded
    # What one way has recorded is known to the other.
    assert load_new_books(spark, str(shelf), str(tmp_path / "manifest")) == 2


def test_names_of_a_batch_come_from_the_listing(spark, shelf, physical):
    plan = physical(books.read_books(spark, str(shelf)).select("fileName"))
    assert "ReadSchema: struct<path:string>" in plan


def test_text_json_and_reset(spark, tmp_path):
    lines, dump, table = (str(tmp_path / n) for n in ("lines", "dump", "table"))
    for words in (["a", "b"], ["c"]):
        files.write_lines(dictionaries.given_words(spark, words), lines)
        files.write_json(dictionaries.given_words(spark, words), dump)
    assert [r.value for r in spark.read.text(lines).collect()] == ["c"]
    assert [r.word for r in spark.read.schema("word string").json(dump).collect()] == ["c"]
    files.reset_table(spark, table, SENTENCES)
    files.reset_table(spark, table, SENTENCES)
    assert spark.read.parquet(table).count() == 0 and spark.read.parquet(table).schema == SENTENCES


def test_index_equals_scan(spark, sentences, tmp_path):
    expected = search.search(sentences, "of the thing").collect()
    for buckets in (1, 4):
        path = str(tmp_path / f"index{buckets}")
        search.write_index(sentences, path, buckets)
        assert search.search_index(spark, path, sentences, "of the thing").collect() == expected
        for phrase in ("the", "the of", "in of the thing notaword"):
            assert search.search_index(spark, path, sentences, phrase).collect() == search.search(sentences, phrase).collect()
    with pytest.raises(ValueError, match="limit"):
        search.search_index(spark, path, sentences, "thing", 10**6)
    assert search.search_index(spark, path, sentences, "notaword").count() == 0


def test_blocks_that_hold_no_hit_are_not_read(spark, tmp_path):
    draw = random.Random(9)
    words = ["of", "in", "it", "so", "on"]
    texts = [" ".join(["the"] * draw.choice([0, 1, 1, 2]) + draw.choices(words, k=draw.randrange(1, 9))) for _ in range(8000)]
    for at in (5, 700, 7001):
        texts[at] = "The rare the rare thing"
    texts[901] = "rare"
    rows = [(f"b{k % 7}", k // 7, t, 0, 0, len(t.split())) for k, t in enumerate(texts)]
    table, path = spark.createDataFrame(rows, SENTENCES), str(tmp_path / "index")
    search.write_index(table, path, 4, block_sentences=16)
    for phrase, limit in [("the rare", 20), ("the rare", 2), ("the", 20), ("the", 3), ("thing the notaword", 7), ("rare", 5), ("the of", 10)]:
        expected = search.search(table, phrase, limit).collect()
        assert search.search_index(spark, path, table, phrase, limit).collect() == expected
    for phrase, limit in [("the rare", 20), ("the", 20)]:
        needed = {r.term: (r.needed, r.postings) for r in search.postings_to_read(spark, path, phrase, limit).collect()}
        assert sum(n for n, _ in needed.values()) < sum(p for _, p in needed.values()) / 10
    every = search.postings_to_read(spark, path, "the of", 10).collect()
    assert len(every) == 2 and all(r.needed == r.postings for r in every)
    assert search.postings_to_read(spark, path, "notaword").count() == 0


def test_an_index_is_written_without_a_shuffle_of_its_postings(spark, tmp_path):
    rows = [(f"b{k}", 0, f"the word{k % 7} goes the way", 1, 0, 5) for k in range(100)]
    table, path = spark.createDataFrame(rows, SENTENCES).repartition(5, "fileName").localCheckpoint(), tmp_path / "index"
    search.write_index(table, str(path), 2, block_sentences=8)
    assert len({f.name.split("-")[1] for f in path.glob("postings/bucket=*/*.parquet")}) == 5
    assert search.search_index(spark, str(path), table, "the word3", 5).collect() == search.search(table, "the word3", 5).collect()


def test_many_blocks_meet_their_postings_in_a_join(spark, tmp_path, monkeypatch):
    names = [(f"b{k}", 0, "the rare word" if k % 50 == 0 else f"the word{k % 7} goes the way", 1, 0, 3 if k % 50 == 0 else 5) for k in range(600)]
    table, path = spark.createDataFrame(names, SENTENCES), str(tmp_path / "index")
    search.write_index(table, path, 2, block_sentences=8)
    expected = search.search(table, "the rare", 5).collect()
    monkeypatch.setattr(search, "MOST_NAMED", 0)
    found = search._Lookup(spark, path, "the rare", 5)
    assert found.skipped == "the" and "LeftSemi" in found.hits._jdf.queryExecution().optimizedPlan().toString()
    assert search.search_index(spark, path, table, "the rare", 5).collect() == expected


def test_stages(spark, folder, sentences):
    raw = tables.document_books(spark, folder)
    staged = readability_stages().fit(raw).transform(raw)
    assert staged.schema.names == sentences.schema.names
    words = syllable_counter().transform(tokenizer().transform(sentence_splitter().transform(raw)))
    difference = words.select(*KEY, "multiSyllableCount").exceptAll(sentences.select(*KEY, "multiSyllableCount"))
    assert difference.count() == 0


def test_a_saved_pipeline_gives_equal_rows_elsewhere(spark, folder, tmp_path):
    raw = tables.document_books(spark, folder)
    stages = Pipeline(stages=[sentence_splitter(abbreviations=["Dr."]), tokenizer(unicode=True), syllable_counter(minSyllables=3)])
    for pipeline, path in ((stages, str(tmp_path / "stages")), (readability_stages(), str(tmp_path / "table"))):
        pipeline.write().overwrite().save(path)
        expected = pipeline.fit(raw).transform(raw)
        back = Pipeline.load(path).fit(raw).transform(raw)
        assert back.columns == expected.columns
        assert back.exceptAll(expected).count() == 0 == expected.exceptAll(back).count()
    # In another session: another process that knows nothing but the folder.
    code = f"""
from pyspark.ml import Pipeline
from tomegauge.session import local_session
from tomegauge.sources import tables
spark = local_session(2, memory="1g")
raw = tables.document_books(spark, {folder!r})
print("rows", Pipeline.load({str(tmp_path / "stages")!r}).fit(raw).transform(raw).selectExpr("sum(multiSyllableCount) as s").first().s)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, cwd=Path(__file__).parent.parent)
    total = stages.fit(raw).transform(raw).selectExpr("sum(multiSyllableCount) as s").first().s
    assert f"rows {total}" in out.stdout, out.stderr[-2000:]


def test_stage_parameters_are_copied(spark):
    stage = syllable_counter(minSyllables=3)
    other = stage.copy({stage.minSyllables: 2})
    assert (stage.getOrDefault(stage.minSyllables), other.getOrDefault(other.minSyllables)) == (3, 2)


def test_scratch_is_in_the_shared_folder(spark):
    from tomegauge.session import scratch_path

    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


class Unset:
    """A session without the shared folder set, on a given master."""

    def __init__(self, master):
        self.sparkContext = SimpleNamespace(master=master, applicationId=f"app-{master}")
        self.conf = SimpleNamespace(get=lambda key, default: default)


def test_scratch_without_a_shared_folder():
    from tomegauge.session import scratch_path

    one, two = (scratch_path(Unset("local[4]"), "x") for _ in "ab")
    assert one != two and one.rsplit("/", 1)[0] == two.rsplit("/", 1)[0]
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Unset("spark://host:7077"), "x")


def test_landing_is_written_once(spark, folder):
    assert landing.sentence_store(spark, folder) == landing.sentence_store(spark, folder)
