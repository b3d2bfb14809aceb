"""Secret scans: candidates by pattern, false positives removed by a random forest, in DataFrame functions only.

A candidate is a long run of key characters within a word; a word may hold many. Its features are
its length, the transitions between kinds of characters, how much of it
dictionary words cover, the path of the document and the words beside it. The
dictionary is the most frequent words of the documents themselves. The forest is
trained on labelled findings and scores all candidates.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tomegauge.llm.common import remainder, stored
from tomegauge.operators.sentences import explode_once

LEAST = 16
CORE = rf"[A-Za-z0-9+/_\-]{{{LEAST},}}={{0,2}}"
#: Characters on either side that a candidate is judged by, so that a long word with many candidates is not copied for each.
REACH = 200
#: Kinds of characters whose transitions are counted.
KINDS = {"lower": "a-z", "upper": "A-Z", "digit": "0-9", "mark": r"+/_=\-"}
#: Words of the dictionary, and their least length.
DICTIONARY, SHORTEST = 400, 4
TREES, DEPTH = 30, 7
#: Labelled findings to train on, per label.
MOST_LABELLED = 20_000
_NAMED = r"(?i)(password|passwd|pwd|secret|token|credential|auth|api[_-]?key|access[_-]?key)"
_MOCK = r"(?i)(example|sample|dummy|placeholder|test|fixture|mock|xxxx)"


def candidates(docs: DataFrame, path: Column | None = None) -> DataFrame:
    """One row per candidate: ``doc_id, path, place`` (number of the word), ``nth`` in its word, ``candidate``, ``lead``, ``before, after``.

    ``lead`` is what stands before it in its word, ``before`` and ``after`` are the two words on either side, each
    as far as ``REACH`` characters.
    """
    path = F.lit(None) if path is None else path
    cut = F.split(F.col("text"), r"[\x20\x09-\x0D]+")
    rows = docs.where(F.col("text").rlike(CORE)).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(path.cast("string"), F.lit("")).alias("path"), cut.alias("_words")
    )
    places = F.expr(f"filter(transform(_words, (w, i) -> if(length(w) >= {LEAST}, i, -1)), i -> i >= 0)")
    rows = rows.withColumn("place", F.explode(places))
    word = F.get("_words", F.col("place"))
    rows = rows.select(
        "doc_id", "path", F.col("place").cast("long").alias("place"), word.alias("word"),
        F.right(F.concat_ws(" ", F.get("_words", F.col("place") - 2), F.get("_words", F.col("place") - 1)), F.lit(REACH)).alias("before"),
        F.left(F.concat_ws(" ", F.get("_words", F.col("place") + 1), F.get("_words", F.col("place") + 2)), F.lit(REACH)).alias("after"),
    )
    rows = rows.where(F.col("word").rlike(CORE)).withColumn("_found", _in_word(F.col("word"))).drop("word")
    rows = explode_once(rows, "_found", "nth", "_one")
    return rows.select("doc_id", "path", "place", F.col("nth").cast("long").alias("nth"), "_one.candidate", "before", "after", "_one.lead")


def _in_word(word: Column) -> Column:
    """All candidates of a word, each with the characters before it.

    Texts between the candidates and these alternate, so the ``REACH`` characters before one lie in the last few of both.
    """
    parts = F.struct(F.split(word, CORE, -1).alias("gaps"), F.regexp_extract_all(word, F.lit(CORE), F.lit(0)).alias("cores"))
    near = REACH // LEAST + 1

    def one(part: Column, core: Column, k: Column) -> Column:
        first, size = F.greatest(k - near, F.lit(0)) + 1, F.least(k, F.lit(near))
        earlier = F.zip_with(F.slice(part["gaps"], first, size), F.slice(part["cores"], first, size), lambda gap, core: F.concat(F.right(gap, F.lit(REACH)), core))
        lead = F.concat(F.array_join(earlier, ""), F.get(part["gaps"], k))
        return F.struct(core.alias("candidate"), F.right(lead, F.lit(REACH)).alias("lead"))

    # The outer step gives the parts a name, so that they are computed once per word.
    return F.transform(F.array(parts), lambda part: F.transform(part["cores"], lambda core, k: one(part, core, k)))[0]


def dictionary(docs: DataFrame, size: int = DICTIONARY) -> list[str]:
    """The most frequent words of ASCII letters in all documents, ties by name."""
    found = F.regexp_extract_all(F.lower("text"), F.lit(f"[a-z]{{{SHORTEST},12}}"), F.lit(0))
    counts = docs.select(F.explode(found).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return [row.word for row in counts.orderBy(F.desc("n"), "word").limit(size).collect()]


def _share(pattern: str) -> Column:
    return F.regexp_count("candidate", F.lit(pattern)) / F.length("candidate")


def with_features(found: DataFrame, words: list[str]) -> tuple[DataFrame, list[str]]:
    """The candidates with their features, and the names of these."""
    features = {"f_length": F.least(F.length("candidate"), F.lit(200)).cast("double")}
    for one, a in KINDS.items():
        features[f"f_{one}"] = _share(f"[{a}]")
        for two, b in KINDS.items():
            features[f"f_{one}_{two}"] = _share(f"[{a}](?=[{b}])")
    features["f_hex"] = _share("[0-9a-fA-F]")
    features["f_distinct"] = F.size(F.array_distinct(F.split("candidate", ""))) / F.length("candidate")
    features["f_vowel_turns"] = _share("(?i)[aeiou](?=[^aeiou])")
    low = F.lower("candidate")
    bare = F.regexp_replace(low, "|".join(sorted(words, key=lambda w: (-len(w), w))), "") if words else low
    features["f_dictionary"] = 1 - F.length(bare) / F.length("candidate")
    features["f_path_mock"] = F.col("path").rlike(_MOCK).cast("double")
    features["f_path_depth"] = F.regexp_count("path", F.lit("/")).cast("double")
    features["f_path_length"] = F.length("path").cast("double")
    features["f_named"] = F.concat_ws(" ", "before", "lead").rlike(_NAMED).cast("double")
    features["f_assigned"] = F.concat_ws(" ", "before", "lead").rlike("[=:]\\s*[\"']?$").cast("double")
    features["f_quoted"] = F.col("lead").rlike("[\"'`]$").cast("double")
    features["f_mock"] = F.concat_ws(" ", "before", "candidate", "after").rlike(_MOCK).cast("double")
    features["f_after_words"] = F.regexp_count("after", F.lit("[A-Za-z]+")).cast("double")
    return found.select("*", *[c.cast("double").alias(n) for n, c in features.items()]), list(features)


def rule_label() -> Column:
    """A label for findings whose nature is beyond doubt, else null: keys of a fixed form or assigned to a telling
    name are secrets; numbers and plain words are not."""
    context = F.concat_ws(" ", "before", "lead")
    fixed = F.col("candidate").rlike("^(AKIA|ASIA)[0-9A-Z]{16}$") | F.col("candidate").rlike("^(ghp|gho|xox[bp])[_-][0-9A-Za-z-]{20,}$")
    assigned = context.rlike(_NAMED + "\\s*[=:]\\s*[\"']?$") & F.col("candidate").rlike("[0-9]") & ~context.rlike(_MOCK)
    harmless = F.col("candidate").rlike("^[0-9]+$") | F.col("candidate").rlike("^[A-Za-z]+$") | F.col("candidate").rlike("^[-_=+/]+$")
    return F.when(fixed, 1.0).when(harmless, 0.0).when(assigned, 1.0)


def findings(docs: DataFrame, path: Column | None = None, label: Column | None = None, threshold: float = 0.5) -> DataFrame:
    """Every candidate in ``docs(doc_id, text)``: ``doc_id, place, nth, candidate, label, held_out, probability, is_secret``.

    ``label`` gives 0, 1 or null per candidate, from its columns. The forest learns
    from labelled findings of two thirds of the documents by a hash of the id, at most
    ``MOST_LABELLED`` per label, the first by a hash of document and place.
    With labels of one kind only, or none, every probability is their share of ones, or 0.

    Null and empty texts have no candidates. Rows that repeat give their
    findings as often. ``place`` counts words from 0, ``nth`` the candidates of a word. Extra columns are ignored; an empty table gives no rows.
    """
    words = dictionary(docs)
    label = rule_label() if label is None else label
    marked, names = with_features(candidates(docs, path), words)
    marked = marked.withColumn("label", label.cast("double")).withColumn("held_out", remainder(F.col("doc_id"), 3) == 1)
    marked = stored(marked.select("doc_id", "place", "nth", "candidate", "label", "held_out", *names), "findings")
    usable = marked.where("label is not null and not held_out")
    parts = [
        usable.where(F.col("label") == k).orderBy(F.xxhash64("doc_id", "place"), "doc_id", "place", "nth", "candidate").limit(MOST_LABELLED) for k in (0, 1)
    ]
    sample = stored(reduce(DataFrame.union, parts), "labelled")
    counts = {row.label: row["count"] for row in sample.groupBy("label").count().collect()}
    output = ["doc_id", "place", "nth", "candidate", "label", "held_out"]
    if len(counts) < 2:
        share = 1.0 if counts.get(1.0) else 0.0
        scored = marked.select(*output, F.lit(share).alias("probability"))
    else:
        gather = VectorAssembler(inputCols=names, outputCol="features")
        forest = RandomForestClassifier(labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=1, featureSubsetStrategy="sqrt")
        model = forest.fit(gather.transform(sample))
        scored = model.transform(gather.transform(marked)).select(*output, vector_to_array("probability")[1].alias("probability"))
    return scored.withColumn("label", F.col("label").cast("int")).withColumn("is_secret", F.col("probability") >= threshold)
