"""Text columns: cleaning, tokens and word splitting, all inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The character class kept by the cleaned text, the token gap,
# and the runs of letters and digits that count as words.
NOT_KEPT = r"[^a-z0-9\s]"
TOKEN_GAP = r"\s+"
WORD = r"[\p{L}\p{N}]+"


#: Kinds of words that hold marks, tried in this order ahead of plain words;
#: their first parts are bounded, so that no run of marks is read over and over.
EMAIL = r"[\p{L}\p{N}][\p{L}\p{N}._%+-]{0,63}@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)+"
URL = r"[a-z][a-z0-9+.-]{0,15}://[^\x00-\x20<>\"]*[\p{L}\p{N}/]"
NUMBER = r"v?\p{N}+(?:[.,]\p{N}+)+"
HYPHENATED = r"[\p{L}\p{N}]+(?:-[\p{L}\p{N}]+)+"
KINDS = "|".join((EMAIL, URL, NUMBER, HYPHENATED, WORD))
#: What tells an address, url or number from other words.
WHOLE_MARKS = "[@:/.,]"


def clean_text(text: Column) -> Column:
    """Lower-case text with everything but a-z, 0-9 and white space removed."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), NOT_KEPT, "")


def tokens(cleaned: Column) -> Column:
    """Tokens of a cleaned text; an empty text has one empty token."""
    return F.split(cleaned, TOKEN_GAP)


def words(text: Column) -> Column:
    """The lower-case words of a text in order; NULL has none."""
    return F.regexp_extract_all(
        F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0)
    )


def word_kinds(text: Column) -> Column:
    """The lower-case words of a text in order, where addresses, urls, decimals
    and versions are words of their own.

    A url is followed by its host, a hyphenated word by its parts; they take
    the next places.  NULL has none.
    """
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(KINDS), F.lit(0))
    return F.flatten(
        F.transform(
            found,
            lambda w: F.when(w.contains("://"), F.array(w, F.regexp_extract(w, "://([^/?#]*)", 1)))
            .when(~w.rlike(WHOLE_MARKS) & w.contains("-"), F.concat(F.array(w), F.split(w, "-")))
            .otherwise(F.array(w)),
        )
    )
