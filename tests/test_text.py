import math

import pytest
from pyspark.sql import functions as F

from newsloom.functions import text as X
from newsloom.functions.lookup import MAX_ENTRIES, lookup

LEXICON = X.Lexicon(
    valence={"good": 1.9, "bad": -2.5},
    boosters={"very": 0.293, "barely": -0.293},
    negations=("never", "n't"),
    stopwords=("the", "it"),
    base_forms={"was": "be", "is": "be"},
)


def run(spark, fn, *values):
    rows = [(v,) for v in values]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(fn(F.col("t"))).collect()]
    return got[0] if len(got) == 1 else got


def compound(total):
    return round(total / math.sqrt(total * total + 15), 4)


def test_preprocess(spark):
    clean = lambda c: X.preprocess_text(c, LEXICON.stopwords, LEXICON.base_forms)
    assert run(spark, clean, "It wasn't the GOOD one!") == "be n't good one !"
    assert run(spark, clean, None) == ""


@pytest.mark.parametrize(
    "text,total",
    [
        ("good", 1.9),
        ("very good", 1.9 + 0.293),
        ("very xx good", 1.9 + 0.293 * 0.95),
        ("very xx yy good", 1.9 + 0.293 * 0.9),
        ("very xx yy zz good", 1.9),
        ("very bad", -2.5 - 0.293),
        ("barely good", 1.9 - 0.293),
        ("it was n't good", 1.9 * -0.74),
        ("never very good", (1.9 + 0.293) * -0.74),
        ("good bad", 1.9 - 2.5),
        ("good!!", 1.9 + 2 * 0.292),
        ("bad!!!!!!", -2.5 - 4 * 0.292),
        ("good??", 1.9 + 2 * 0.18),
        ("good????", 1.9 + 0.96),
        ("nothing!!", 0.0),
    ],
)
def test_lexicon_score(spark, text, total):
    assert run(spark, lambda c: X.lexicon_score(c, LEXICON), text) == pytest.approx(compound(total), abs=1e-9)


def test_null_text_scores_zero(spark):
    assert run(spark, lambda c: X.lexicon_score(c, LEXICON), None) == 0.0


def test_labels(spark):
    df = spark.createDataFrame([(0.05,), (-0.05,), (0.049,), (0.0,)], "s double")
    assert [r[0] for r in df.select(X.sentiment_label(F.col("s"))).collect()] == [
        "Positive", "Negative", "Neutral", "Neutral",
    ]


@pytest.mark.parametrize("a,b,expected", [(0.5, 0.1, 0.3), (0.5, 0.0, 0.5), (0.0, -0.2, -0.2), (0.0, 0.0, 0.0)])
def test_average(spark, a, b, expected):
    df = spark.createDataFrame([(a, b)], "a double, b double")
    assert df.select(X.average_of_nonzero(F.col("a"), F.col("b"))).first()[0] == pytest.approx(expected)


def test_sentences(spark):
    assert run(spark, X.split_sentences, " One. Two! Three?  x.y 4 ") == ["One.", "Two!", "Three?", "x.y 4"]
    assert run(spark, X.split_sentences, None) == []
    assert run(spark, X.split_sentences, "  \n ") == []


def test_normalize_sentence(spark):
    assert run(spark, X.normalize_sentence, "  A  B\tc, ") == "a b c,"
    assert run(spark, lambda c: X.normalize_sentence(c, "tokens"), "A  B\tc,d") == "a b c , d"
    assert run(spark, lambda c: X.normalize_sentence(c, "hybrid"), "A  B\tc,d") == "a b c , d"


def test_keyword_tickers(spark):
    words = {"btc": ["bitcoin", "btc"], "eth": ["Ether"], "leo": ["unus sedo leo"]}
    tag = lambda c: X.keyword_tickers(c, words)
    assert run(spark, tag, "ETHER, bitcoin's BTC; unus sedo leo") == ["BTC", "ETH"]
    assert run(spark, tag, None) == []


def test_search_terms(spark):
    stems = {"bitcoiners": "bitcoin", "mining": "mine"}
    asked = "bitcoin OR btc AND mining"
    prefix = lambda c: X.prefix_terms(c, asked, stems)
    found = lambda c: X.prefix_terms(c, asked, stems, return_search_terms=False)
    assert run(spark, prefix, "Bitcoiners' miner") == ["bitcoin", "mining"]
    assert run(spark, prefix, "nothing here") == ["bitcoin", "btc", "mining"]
    assert run(spark, found, "Bitcoiners' miner") == ["bitcoiners", "miner"]
    assert run(spark, found, "nothing here") == []
    exact = lambda c: X.stem_terms(c, asked, stems)
    assert run(spark, exact, "$BTC for bitcoiners, miner") == ["bitcoin", "btc"]
    assert run(spark, exact, "mine") == ["mining"]
    assert run(spark, exact, "") == []


def test_lookup_of_many_entries(spark):
    entries = {f"w{i}": i for i in range(5000)}
    df = spark.range(6000).select("id", F.concat(F.lit("w"), F.col("id").cast("string")).alias("w"))
    got = df.select("id", lookup(entries, "bigint")(F.col("w")).alias("v")).collect()
    assert all(r.v == (r.id if r.id < 5000 else None) for r in got)
    with pytest.raises(ValueError):
        lookup(dict.fromkeys(map(str, range(MAX_ENTRIES + 1)), 1), "int")


def test_base_forms_decide_what_counts_as_a_word(spark):
    lexicon = X.Lexicon({"good": 1.9, "you": 1.0}, {"very": 0.293}, base_forms={"u": "you", "xx": "x"})
    score = lambda c: X.lexicon_score(c, lexicon)
    assert run(spark, score, "u") == pytest.approx(compound(1.0))
    # The single letter and what becomes one are no words, so the booster still is the next before.
    assert run(spark, score, "very xx z good") == pytest.approx(compound(1.9 + 0.293))


def test_english_lexicon_from_files(spark, tmp_path):
    (tmp_path / "valence.tsv").write_text("good\t1.9\t0.9\t[2, 1]\n:)\t2.0\t1\t[2]\n\"odd\t-1.0\t0\t[]\n")
    (tmp_path / "lemmas.tsv").write_text("goods\tgood\n")
    valence = X.read_dictionary(spark, str(tmp_path / "valence.tsv"))
    assert valence == {"good": 1.9, ":)": 2.0, '"odd': -1.0}
    lexicon = X.english_lexicon(valence, X.read_dictionary(spark, str(tmp_path / "lemmas.tsv"), "string"))
    score = lambda c: X.lexicon_score(c, lexicon)
    assert run(spark, score, "The goods") == pytest.approx(compound(1.9))
    # "not" and "very" are stopwords and gone before scoring; "never" and "extremely" are not.
    assert run(spark, score, "not very good") == pytest.approx(compound(1.9))
    assert run(spark, score, "never extremely good") == pytest.approx(compound((1.9 + 0.293) * -0.74))


RULES = X.Lexicon(
    valence={"good": 1.9, "bad": -2.5, "doubt": -1.5, "ass": -2.5, "right": 1.0},
    boosters={"very": 0.293, "sort of": -0.293},
    negations=("never", "without", "n't"),
    rules=True,
    idioms={"bad ass": 1.5, "yeah right": -2.0, "kiss of death": -1.5, "good as gold": 3.0},
)


@pytest.mark.parametrize(
    "text,total",
    [
        ("never good", 1.9 * -0.74),
        ("never so good", 1.9 * 1.5),
        ("never this good", 1.9 * 1.5),
        ("never so very good", (1.9 + 0.293) * 1.25),
        ("xx yy so good", 1.9 * 1.25),
        ("without doubt good", -1.5 * -0.74 + 1.9 * -0.74),
        ("least good", 1.9 * -0.74),
        ("xx least good", 1.9 * -0.74),
        ("at least good", 1.9),
        ("very least good", 1.9 + 0.293 * 0.95),
        ("good but bad", 1.9 * 0.5 - 2.5 * 1.5),
        ("but good", 1.9 * 1.5),
        ("xx yy zz bad ass", -2.5 * 0 + 1.5 + 1.5),  # either word of the idiom has its valence
        ("bad ass", -5.0),  # too early: idioms ask for three words before
        ("xx yy zz yeah right", -2.0),
        ("xx yy sort of good", 1.9 - 0.293),
        ("xx yy zz good as gold", 3.0),
    ],
)
def test_rules_on_several_words(spark, text, total):
    assert run(spark, lambda c: X.lexicon_score(c, RULES), text) == pytest.approx(compound(total), abs=1e-9)


def test_rules_hold_for_the_english_lexicon_and_no_other(spark):
    lexicon = X.english_lexicon({"good": 1.9})
    assert lexicon.rules and lexicon.idioms and "kind of" in lexicon.pairs()
    assert run(spark, lambda c: X.lexicon_score(c, lexicon), "least good") == pytest.approx(compound(1.9 * -0.74))
    assert run(spark, lambda c: X.lexicon_score(c, LEXICON), "least good") == pytest.approx(compound(1.9))
