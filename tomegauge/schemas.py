"""Fixed schemas, so that no read or conversion needs an inference job."""

from pyspark.sql import types as T

BOOKS = T.StructType(
    [
        T.StructField("fileName", T.StringType()),
        T.StructField("rawDocument", T.StringType()),
    ]
)

# One row per sentence. (fileName, position) is the key.
SENTENCES = T.StructType(
    [
        T.StructField("fileName", T.StringType()),
        T.StructField("position", T.IntegerType()),
        T.StructField("sentenceText", T.StringType()),
        T.StructField("numSentencesInBook", T.IntegerType()),
        T.StructField("multiSyllableCount", T.IntegerType()),
        T.StructField("numWordsInSentence", T.IntegerType()),
    ]
)

SENTENCE_COLUMNS = SENTENCES.fieldNames()

# The sentence row as it rests in JSON: the key travels inside the document.
INDEX_DOCUMENT = T.StructType(
    [T.StructField("sentence_id", T.StringType())] + SENTENCES.fields
)

LEXICON = T.StructType(
    [
        T.StructField("word", T.StringType()),
        T.StructField("label", T.StringType()),
    ]
)

LEMMAS = T.StructType(
    [
        T.StructField("form", T.StringType()),
        T.StructField("lemma", T.StringType()),
    ]
)
