"""Trigram sets and their similarity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trawl.functions.text import words


def word_trigrams(word: Column) -> Column:
    """Every 3-gram of one word padded by two blanks before and one after."""
    padded = F.concat(F.lit("  "), word, F.lit(" "))
    starts = F.sequence(F.lit(1), F.length(word) + 1)
    return F.transform(starts, lambda i: F.substring(padded, i, F.lit(3)))


def trigram_set(text: Column) -> Column:
    """The distinct trigrams of all words of a text."""
    return F.array_distinct(F.flatten(F.transform(words(text), word_trigrams)))


def set_similarity(a: Column, b: Column) -> Column:
    """Shared over total members of two sets, 0 when both are empty.

    The ratio is held in single precision, where one in five is just above a
    threshold of 0.2 and so passes a strict comparison with it.
    """
    shared = F.size(F.array_intersect(a, b))
    total = F.size(a) + F.size(b) - shared
    ratio = F.when(total > 0, shared / total).otherwise(F.lit(0.0))
    return ratio.cast("float")


def similarity(a: Column, b: Column) -> Column:
    """Trigram similarity of two strings."""
    return set_similarity(trigram_set(a), trigram_set(b))
