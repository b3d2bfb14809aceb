"""Column functions on text: cleaning, sentences, tokens, syllables.

All are built-in expressions, so rows never leave the JVM. Counts over a whole
sentence use one regular expression each instead of a lambda per word: the
lambdas of ``transform`` and ``aggregate`` are interpreted, ``regexp_count`` is
part of the generated code.
"""

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# They decide which words count as multi-syllable.
VOWELS = "aeiouy"
SILENT_ENDINGS = ("es", "e")
MULTI_SYLLABLE_FROM = 2

# Sentence ends, and what may close a quotation after one.
SENTENCE_ENDS = ".!?"
CLOSERS = "\"')]"

# The characters of a token, ASCII and Unicode. All others are gaps.
IN_WORD = r"\w"
UNICODE_IN_WORD = r"[\p{L}\p{N}_]"

WHITE_SPACE = " \t\n\x0b\f\r"

_V = f"[{VOWELS}]"
_C = rf"[\w&&[^{VOWELS}]]"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def newlines_to_spaces(text: Column | str) -> Column:
    """Each line feed becomes one space."""
    return F.replace(_column(text), F.lit("\n"), F.lit(" "))


def line_breaks_to_spaces(text: Column | str) -> Column:
    """Each line feed and each carriage return becomes one space."""
    return F.replace(newlines_to_spaces(text), F.lit("\r"), F.lit(" "))


def space_before(text: Column | str) -> Column:
    """The white space a text begins with."""
    return F.left(_column(text), F.length(_column(text)) - F.length(F.ltrim(_column(text), F.lit(WHITE_SPACE))))


def space_after(text: Column | str) -> Column:
    """The white space a text ends with."""
    return F.right(_column(text), F.length(_column(text)) - F.length(_without_end_space(text)))


def chunks(text: Column | str, size: int) -> Column:
    """A text in pieces of ``size`` characters or a little more, each up to the end of white space."""
    return F.regexp_extract_all(_column(text), F.lit(rf"(?s).{{1,{size}}}+\S*+\s*+"), F.lit(0))


def base_name(path: Column | str) -> Column:
    """What follows the last slash."""
    return F.substring_index(_column(path), "/", -1)


def sentence_array(text: Column | str, abbreviations: Sequence[str] = ()) -> Column:
    """The sentences of a text, trimmed, none empty.

    A sentence ends at a run of ``.!?`` with optional closing quotes or brackets,
    if white space or the end of the text follows. One expression matches whole
    sentences, so the text is walked once and no marker character is needed. A
    full stop after one of ``abbreviations`` does not end a sentence.
    """
    return F.regexp_extract_all(_without_end_space(text), F.lit(_sentence(abbreviations)), F.lit(0))


_END = rf"[{SENTENCE_ENDS}]++[{re.escape(CLOSERS)}]*+"


def _names(abbreviations: Sequence[str]) -> str:
    return rf"(?<!\w)(?:{'|'.join(re.escape(a.rstrip('.')) for a in abbreviations)})"


def _sentence(abbreviations: Sequence[str]) -> str:
    inside = [rf"[^{SENTENCE_ENDS}]++", rf"{_END}(?!\s|\z)"]
    if abbreviations:
        inside.insert(1, rf"(?<={_names(abbreviations)})\.(?=\s)")
    return rf"(?=\S)(?:{'|'.join(inside)})*+(?:{_END}|\z)"


def _without_end_space(text: Column | str) -> Column:
    return F.rtrim(_column(text), F.lit(WHITE_SPACE))


def sentence_count(text: Column | str, abbreviations: Sequence[str] = ()) -> Column:
    """Number of ``sentence_array(text)``, without building the array."""
    return F.regexp_count(_without_end_space(text), F.lit(_sentence(abbreviations)))


def ends_open(text: Column | str, abbreviations: Sequence[str] = ()) -> Column:
    """Whether the last sentence of a text goes on, if more text follows after white space."""
    text = _without_end_space(text)
    open_end = ~F.rlike(text, F.lit(rf"{_END}\z"))
    return open_end | F.rlike(text, F.lit(rf"{_names(abbreviations)}\.\z")) if abbreviations else open_end


def tokens(sentence: Column | str, unicode: bool = False) -> Column:
    """Lower-case tokens: what a split at all other characters leaves, but for empty ones."""
    return F.regexp_extract_all(F.lower(_column(sentence)), F.lit(_token(unicode)), F.lit(0))


def _token(unicode: bool) -> str:
    return f"{UNICODE_IN_WORD if unicode else IN_WORD}++"


def token_runs(sentence: Column | str, unicode: bool = False) -> Column:
    """The sorted tokens with equal ones joined by spaces: ``a b a`` gives ``[a a, b]``.

    Counts repeats within a sentence without a grouping; see ``run_token`` and ``run_length``.
    """
    joined = F.array_join(F.sort_array(tokens(sentence, unicode)), " ")
    return F.regexp_extract_all(joined, F.lit(r"([^ ]++)(?: \1(?![^ ]))*+"), F.lit(0))


def run_token(run: Column | str) -> Column:
    return F.substring_index(_column(run), " ", 1)


def run_length(run: Column | str) -> Column:
    run = _column(run)
    return ((F.length(run) + 1) / (F.length(run_token(run)) + 1)).cast("bigint")


def word_count(sentence: Column | str, unicode: bool = False) -> Column:
    """Number of ``tokens(sentence)``, without building the array."""
    return F.regexp_count(F.lower(_column(sentence)), F.lit(_token(unicode)))


def has_any_term(sentence: Column | str, terms: Sequence[str], unicode: bool = False) -> Column:
    """Whether one of the lower-case terms is among the tokens; stops at the first."""
    in_word = UNICODE_IN_WORD if unicode else IN_WORD
    pattern = f"(?<!{in_word})(?:{'|'.join(map(re.escape, terms))})(?!{in_word})"
    return F.rlike(F.lower(_column(sentence)), F.lit(pattern))


def vowel_runs(word: Column | str) -> Column:
    """Vowel runs of a word, one less if it ends in a silent e."""
    word = _column(word)
    silent = F.lit(False)
    for ending in SILENT_ENDINGS:
        silent = silent | (word.endswith(ending) & (F.length(word) > len(ending)))
    return F.regexp_count(word, F.lit(f"{_V}+")) - silent.cast("int")


def syllables(word: Column | str) -> Column:
    """Syllables of a word: at least one."""
    return F.greatest(F.lit(1), vowel_runs(word))


def multi_syllable_flag(word: Column | str, min_syllables: int = MULTI_SYLLABLE_FROM) -> Column:
    """1 for a word of ``min_syllables`` or more, else 0. Case matters: vowels are lower case."""
    return (vowel_runs(word) >= min_syllables).cast("int")


def multi_syllable_flags(sentence: Column | str) -> Column:
    """Flags of a raw sentence cut at single spaces, case and punctuation kept."""
    return F.transform(F.split(_column(sentence), " "), lambda word: multi_syllable_flag(word))


def sum_of_flags(flags: Column | str) -> Column:
    return F.aggregate(_column(flags), F.lit(0), lambda total, flag: total + flag)


def multi_syllable_words(words: Column | str, min_syllables: int = MULTI_SYLLABLE_FROM) -> Column:
    """Multi-syllable words of a token array."""
    flags = F.transform(_column(words), lambda word: multi_syllable_flag(word, min_syllables))
    return sum_of_flags(flags)


def _multi_syllable_token(min_syllables: int) -> str:
    """Matches whole tokens with one vowel run more than asked for, or just as many and no silent ending."""
    if min_syllables < 2:
        raise ValueError("min_syllables must be 2 or more")
    runs = rf"{_C}*+{_V}++(?:{_C}++{_V}++){{{min_syllables - 1}}}"
    sounded = "".join(f"(?<!{ending})" for ending in SILENT_ENDINGS)
    return rf"{runs}(?:{_C}++{_V}\w*+|{_C}*+(?!\w){sounded})"


def multi_syllable_count(sentence: Column | str, min_syllables: int = MULTI_SYLLABLE_FROM) -> Column:
    """Multi-syllable words of a sentence, equal to ``multi_syllable_words(tokens(sentence))``."""
    pattern = rf"(?<!\w){_multi_syllable_token(min_syllables)}"
    return F.regexp_count(F.lower(_column(sentence)), F.lit(pattern))


def tokens_by_flag(sentence: Column | str, flag: int, min_syllables: int = MULTI_SYLLABLE_FROM) -> Column:
    """The tokens of a sentence that are multi-syllable words (flag 1), or those that are not (flag 0)."""
    multi = _multi_syllable_token(min_syllables)
    pattern = rf"(?<!\w){multi}" if flag else rf"(?<!\w)(?!{multi})\w++"
    return F.regexp_extract_all(F.lower(_column(sentence)), F.lit(pattern), F.lit(0))


def has_sentence(text: Column | str) -> Column:
    """Whether a text has any sentence, that is, anything but white space."""
    return F.rlike(_column(text), F.lit(r"\S"))


def syllable_count(sentence: Column | str) -> Column:
    """Syllables of a sentence, equal to the sum of ``syllables`` over its tokens.

    Counts the vowel runs that are not a silent ending, and each token that has
    no other.
    """
    silent = r"(?<=e)s?(?!\w)"
    pattern = rf"{_V}++(?!{silent})|(?<!\w)(?=\w){_C}*+(?:{_V}++(?<=e)s?)?(?!\w)"
    return F.regexp_count(F.lower(_column(sentence)), F.lit(pattern))
