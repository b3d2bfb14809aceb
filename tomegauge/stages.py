"""The same transformations as stages of a ``pyspark.ml`` pipeline.

A stage has parameters and calls a DataFrame function with them; there is nothing
to train, so ``fit`` runs no job. Stages and pipelines can be saved and loaded in another session.
"""

from pyspark.ml import Pipeline, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from tomegauge.functions import text
from tomegauge.operators import sentences
from tomegauge.schemas import SENTENCE_COLUMNS


class _Stage(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A stage whose parameters are set by name; ``_defaults`` are those it starts with."""

    _defaults: dict = {}

    def __init__(self, **params):
        super().__init__()
        self._setDefault(**self._defaults)
        self._set(**params)

    def _value(self, name: str):
        return self.getOrDefault(getattr(self, name))


class SentenceSplitter(_Stage):
    """Books to sentences."""

    abbreviations = Param(Params._dummy(), "abbreviations", "words whose full stop ends no sentence", TypeConverters.toListString)
    _defaults = {"abbreviations": []}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return sentences.split_books(dataset, self._value("abbreviations"))


class WordTokenizer(_Stage, HasInputCol, HasOutputCol):
    """Add the token array of a column."""

    unicode = Param(Params._dummy(), "unicode", "whether letters and digits of all scripts make words", TypeConverters.toBoolean)
    _defaults = {"inputCol": "sentenceText", "outputCol": "words", "unicode": False}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(), text.tokens(self.getInputCol(), self._value("unicode")))


class _Counting(_Stage):
    minSyllables = Param(Params._dummy(), "minSyllables", "syllables from which a word counts as multi-syllable", TypeConverters.toInt)


class SyllableCounter(_Counting, HasInputCol, HasOutputCol):
    """Add the multi-syllable words of a token array."""

    _defaults = {"inputCol": "words", "outputCol": "multiSyllableCount", "minSyllables": text.MULTI_SYLLABLE_FROM}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        count = text.multi_syllable_words(self.getInputCol(), self._value("minSyllables"))
        return dataset.withColumn(self.getOutputCol(), count)


class SentenceCounter(_Counting):
    """Add both word counts of a sentence and keep the columns of the sentence table."""

    _defaults = {"minSyllables": text.MULTI_SYLLABLE_FROM}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return sentences.count_words(dataset, self._value("minSyllables")).select(*SENTENCE_COLUMNS)


def sentence_splitter(**params) -> SentenceSplitter:
    return SentenceSplitter(**params)


def tokenizer(input_col: str = "sentenceText", output_col: str = "words", unicode: bool = False) -> WordTokenizer:
    return WordTokenizer(inputCol=input_col, outputCol=output_col, unicode=unicode)


def syllable_counter(input_col: str = "words", output_col: str = "multiSyllableCount", **params) -> SyllableCounter:
    return SyllableCounter(inputCol=input_col, outputCol=output_col, **params)


def sentence_counter(**params) -> SentenceCounter:
    return SentenceCounter(**params)


def readability_stages() -> Pipeline:
    """Books to the sentence table."""
    return Pipeline(stages=[sentence_splitter(), sentence_counter()])
