import pytest

from trawl.functions.stemming import STOP_WORDS, stem_word

# Published examples of the algorithm.
PAIRS = """
consign consign, consigned consign, consigning consign, consignment consign,
consist consist, consisted consist, consistency consist, consolation consol,
consolatory consolatori, consolingly consol, conspiracy conspiraci,
constables constabl, constancy constanc, knack knack, knackeries knackeri,
knaves knave, knavish knavish, kneaded knead, kneel kneel, knightly knight,
knotted knot, knots knot, caresses caress, flies fli, dies die, ties tie,
cries cri, gas gas, this this, gaps gap, kiwis kiwi, agreed agre, hopping hop,
hoping hope, luxuriated luxuri, happy happi, say say, by by, enjoy enjoy,
national nation, relational relat, conditional condit, operator oper,
decisiveness decis, hopefulness hope, callousness callous, electrical electr,
goodness good, allowance allow, inference infer, airliner airlin,
adjustable adjust, defensible defens, replacement replac, adjustment adjust,
dependent depend, adoption adopt, effective effect, rate rate, cease ceas,
roll roll, generate generat, generously generous, communities communiti,
skies sky, dying die, early earli, news news, inning inning, proceed proceed,
networks network, deploying deploy, learning learn, machine machin,
booking book, policies polici, policy polici, fees fee, changes chang,
yellow yellow, youth youth, boy boy, boyish boyish, flying fli
"""


@pytest.mark.parametrize("pair", [p.split() for p in PAIRS.replace("\n", " ").split(",")], ids=lambda p: p[0])
def test_stem(pair):
    assert stem_word(pair[0]) == pair[1]


def test_words_with_digits_and_short_words_stay():
    assert [stem_word(w) for w in ("365s", "is", "a", "b2bs")] == ["365s", "is", "a", "b2bs"]


def test_stop_list():
    assert len(STOP_WORDS) == len(set(STOP_WORDS)) == 127


def test_sql_stems_agree():
    """The oracle's stemmer, written apart as regular expressions, on made-up words with all endings."""
    import itertools
    import random

    import duckdb
    import pandas as pd

    from trawl.functions.stemming import KEPT_AFTER_PLURAL, STEP_2, STEP_3, STEP_4, STOP_WORDS, WHOLE_WORDS, stem_word
    from trawl.plans.querybook import sql

    rng = random.Random(7)
    endings = ["", "s", "sses", "ied", "ies", "ss", "us", "eed", "eedly", "ed", "edly", "ing", "ingly", "y", "e", "ll", *STEP_2, *STEP_3, *STEP_4]
    starts = ["gener", "commun", "arsen", "y", "by", "say", "bb", "x", *("".join(rng.choice("abcdeilmnoprstuvwxyzé") for _ in range(rng.randrange(1, 7))) for _ in range(400))]
    words = {a + b + c for a in starts for b, c in itertools.product(endings, ("", "s", "ly", "ing")) if rng.random() < 0.3}
    words = (words | set(WHOLE_WORDS) | KEPT_AFTER_PLURAL | {"a1s", "ab"}) - set(STOP_WORDS) - {""}
    con = duckdb.connect()
    con.register("given", pd.DataFrame({"word": sorted(words)}))
    got = dict(con.execute(f"WITH {sql.stems('given')} SELECT word, stem FROM stemmed").fetchall())
    assert len(got) > 10_000 and {w: s for w, s in got.items() if s != stem_word(w)} == {}
