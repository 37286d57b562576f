"""English stemming (the published Porter2 algorithm) over distinct words.

The stemmer itself is a small word -> word helper.  It is always applied to a
*vocabulary* (the distinct words of a corpus or of a query table), never once
per occurrence; see ``trawl.operators.lexicon``.
"""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The English stop list of the text configuration.
STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves
    he him his himself she her hers herself it its itself they them their
    theirs themselves what which who whom this that these those am is are was
    were be been being have has had having do does did doing a an the and but
    if or because as until while of at by for with about against between into
    through during before after above below to from up down in out on off over
    under again further then once here there when where why how all any both
    each few more most other some such no nor not only own same so than too
    very s t can will just don should now
    """.split()
)

# Fixed values of the stemming algorithm.
WHOLE_WORDS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie",
    "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli",
    "early": "earli", "only": "onli", "singly": "singl", "sky": "sky",
    "news": "news", "howe": "howe", "atlas": "atlas", "cosmos": "cosmos",
    "bias": "bias", "andes": "andes",
}
KEPT_AFTER_PLURAL = {
    "inning", "outing", "canning", "herring", "earring", "proceed", "exceed",
    "succeed",
}
REGION_PREFIXES = ("gener", "commun", "arsen")
VOWELS = frozenset("aeiouy")
DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
LI_ENDINGS = frozenset("cdeghkmnrt")
STEP_2 = {
    "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able",
    "entli": "ent", "izer": "ize", "ization": "ize", "ational": "ate",
    "ation": "ate", "ator": "ate", "alism": "al", "aliti": "al", "alli": "al",
    "fulness": "ful", "ousli": "ous", "ousness": "ous", "iveness": "ive",
    "iviti": "ive", "biliti": "ble", "bli": "ble", "ogi": "og",
    "fulli": "ful", "lessli": "less", "li": "",
}
STEP_3 = {
    "tional": "tion", "ational": "ate", "alize": "al", "icate": "ic",
    "iciti": "ic", "ical": "ic", "ful": "", "ness": "", "ative": "",
}
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment",
    "ent", "ism", "ate", "iti", "ous", "ive", "ize", "ion",
)


def _ending(word: str, endings) -> str | None:
    """The longest of ``endings`` that ``word`` ends with."""
    return max((e for e in endings if word.endswith(e)), key=len, default=None)


def _has_vowel(part: str) -> bool:
    return any(ch in VOWELS for ch in part)


def _after_vowel_consonant(word: str, start: int) -> int:
    """Start of the region after the first non-vowel that follows a vowel."""
    for i in range(start + 1, len(word)):
        if word[i] not in VOWELS and word[i - 1] in VOWELS:
            return i + 1
    return len(word)


def _ends_short(word: str) -> bool:
    """True when ``word`` ends in a short syllable."""
    if len(word) == 2:
        return word[0] in VOWELS and word[1] not in VOWELS
    return (
        len(word) > 2
        and word[-1] not in VOWELS
        and word[-1] not in "wxY"
        and word[-2] in VOWELS
        and word[-3] not in VOWELS
    )


def _plural(w: str) -> str:
    end = _ending(w, ("sses", "ied", "ies", "us", "ss", "s"))
    if end == "sses":
        return w[:-2]
    if end in ("ied", "ies"):
        return w[:-2] if len(w) > 4 else w[:-1]
    if end == "s" and _has_vowel(w[:-2]):
        return w[:-1]
    return w


def _past(w: str, r1: int) -> str:
    end = _ending(w, ("eed", "eedly", "ed", "edly", "ing", "ingly"))
    if end is None:
        return w
    base = w[: -len(end)]
    if end in ("eed", "eedly"):
        return base + "ee" if len(base) >= r1 else w
    if not _has_vowel(base):
        return w
    if base.endswith(("at", "bl", "iz")):
        return base + "e"
    if base.endswith(DOUBLES):
        return base[:-1]
    if len(base) <= r1 and _ends_short(base):
        return base + "e"
    return base


def _derived(w: str, r1: int, r2: int) -> str:
    end = _ending(w, STEP_2)
    if end and len(w) - len(end) >= r1:
        base = w[: -len(end)]
        if end == "li":
            w = base if base[-1:] in LI_ENDINGS else w
        elif end != "ogi" or base.endswith("l"):
            w = base + STEP_2[end]
    end = _ending(w, STEP_3)
    if end and len(w) - len(end) >= r1:
        if end != "ative" or len(w) - len(end) >= r2:
            w = w[: -len(end)] + STEP_3[end]
    end = _ending(w, STEP_4)
    if end and len(w) - len(end) >= r2:
        base = w[: -len(end)]
        if end != "ion" or base.endswith(("s", "t")):
            w = base
    if w.endswith("e"):
        cut = len(w) - 1
        if cut >= r2 or (cut >= r1 and not _ends_short(w[:-1])):
            w = w[:-1]
    elif w.endswith("ll") and len(w) - 1 >= r2:
        w = w[:-1]
    return w


@lru_cache(maxsize=1 << 16)
def stem_word(word: str) -> str:
    """Stem one lower-case word; words with digits and short words stay."""
    if len(word) <= 2 or any(ch.isdigit() for ch in word):
        return word
    if word in WHOLE_WORDS:
        return WHOLE_WORDS[word]
    w = "".join(
        "Y" if ch == "y" and (i == 0 or word[i - 1] in VOWELS) else ch
        for i, ch in enumerate(word)
    )
    head = next((p for p in REGION_PREFIXES if w.startswith(p)), None)
    r1 = len(head) if head else _after_vowel_consonant(w, 0)
    r2 = _after_vowel_consonant(w, r1)
    w = _plural(w)
    if w in KEPT_AFTER_PLURAL:
        return w
    w = _past(w, r1)
    if len(w) > 2 and w[-1] in "yY" and w[-2] not in VOWELS:
        w = w[:-1] + "i"
    return _derived(w, r1, r2).replace("Y", "y")


@F.pandas_udf(T.StringType())
def english_stem(words: pd.Series) -> pd.Series:
    """Stem a column of distinct lower-case words."""
    return words.map(stem_word, na_action="ignore")
