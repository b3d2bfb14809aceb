"""Readability formulae as column functions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The SMOG formula.
SMOG_FACTOR = 1.0430
SMOG_SENTENCES = 30
SMOG_OFFSET = 3.1291

# Flesch reading ease and Flesch-Kincaid grade.
EASE_OFFSET = 206.835
EASE_PER_WORD = 1.015
EASE_PER_SYLLABLE = 84.6
GRADE_PER_WORD = 0.39
GRADE_PER_SYLLABLE = 11.8
GRADE_OFFSET = 15.59

# The Dale-Chall formula.
CHALL_PER_PERCENT = 0.1579
CHALL_PER_WORD = 0.0496
CHALL_ADJUSTMENT = 3.6365
CHALL_ADJUST_ABOVE = 5


def _ratio(part: Column, whole: Column) -> Column:
    return part / F.nullif(whole, F.lit(0))


def smog_exact(multi: Column, sentences: Column) -> Column:
    return SMOG_FACTOR * F.sqrt(_ratio(SMOG_SENTENCES * multi, sentences)) + SMOG_OFFSET


def smog(multi: Column, sentences: Column) -> Column:
    """SMOG grade to two decimals."""
    return F.round(smog_exact(multi, sentences), 2)


def multi_syllables_for(grade: Column, sentences: Column) -> Column:
    """Multi-syllable words that give ``grade`` over ``sentences``: SMOG turned round."""
    root = F.greatest(grade - SMOG_OFFSET, F.lit(0.0)) / SMOG_FACTOR
    return sentences / SMOG_SENTENCES * (root * root)


def reading_ease(words: Column, sentences: Column, syllables: Column) -> Column:
    """Flesch reading ease to two decimals; NULL without words."""
    ease = EASE_OFFSET - EASE_PER_WORD * _ratio(words, sentences) - EASE_PER_SYLLABLE * _ratio(syllables, words)
    return F.round(ease, 2)


def flesch_grade(words: Column, sentences: Column, syllables: Column) -> Column:
    """Flesch-Kincaid grade to two decimals; NULL without words."""
    grade = GRADE_PER_WORD * _ratio(words, sentences) + GRADE_PER_SYLLABLE * _ratio(syllables, words) - GRADE_OFFSET
    return F.round(grade, 2)


def dale_chall(difficult: Column, words: Column, sentences: Column) -> Column:
    """Dale-Chall score to two decimals; NULL without words."""
    percent = 100 * _ratio(difficult, words)
    adjustment = F.when(percent > CHALL_ADJUST_ABOVE, CHALL_ADJUSTMENT).otherwise(0.0)
    return F.round(CHALL_PER_PERCENT * percent + CHALL_PER_WORD * _ratio(words, sentences) + adjustment, 2)
