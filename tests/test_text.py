import pytest
from helpers import rows
from pyspark.sql import functions as F

from holdfast.functions import columns as C
from holdfast.functions import similarity as S
from holdfast.functions import text as X
from holdfast.specs import EXACT, LOOSE, NAME_REPLACEMENTS, RECOMMEND, TextSpec


def one(spark, c, *values):
    df = spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(c(*(F.col(f"c{i}") for i in range(len(values)))).alias("x")).first().x


@pytest.mark.parametrize("name, spec, want", [
    ("Zeta LTD Alpha 12", EXACT, ["alpha", "limited", "zeta"]),
    ("a+b", EXACT, ["ab"]),
    ("Müller & Co.", EXACT, ["co", "ller", "m"]),
    ("bb aa bb", EXACT, ["aa", "bb", "bb"]),
    ("", EXACT, []),
    (None, EXACT, None),
    ("The Same Investment of Capital and small", LOOSE, ["capital", "investment", "small"]),
    ("the and of", RECOMMEND, []),
    ("Müller", RECOMMEND, ["mller"]),
    ("Müller", TextSpec(unicode=True), ["müller"]),
    ("A b", TextSpec(tokenize=False), "a b"),
])
def test_normalise(spark, name, spec, want):
    assert one(spark, lambda c: X.normalise(c, spec), name) == want


def test_replacement_works_inside_words(spark):
    assert one(spark, lambda c: X.replace_values(c, NAME_REPLACEMENTS), "altdorf ltd") == "alimitedorf limited"


def test_vocabulary_ranks_share_ties(spark):
    df = spark.createDataFrame([("b a a",), ("c b A d",), (None,)], "t string")
    assert rows(X.vocabulary(df, "t")) == [(0, "a", 3), (1, "b", 2), (2, "c", 1), (2, "d", 1)]
    assert X.top_words(df, "t", 3) == ["a", "b", "c", "d"]


def test_first_contained_follows_the_list(spark):
    code = lambda c: C.first_contained(c, ["S12", "S1", "S2"])
    assert [one(spark, code, v) for v in ("xS1S12", "S15", "none", None)] == ["S12", "S1", None, None]


def test_keyword_flags_are_case_sensitive_and_ltd_adds_up(spark):
    df = spark.createDataFrame([("ltd limited",), ("LTD",)], "n string")
    flags = C.contains_flags(F.col("n"), ["ltd", "limited"])
    assert rows(df.select(*(x.alias(w) for w, x in flags.items()))) == [(0.0, 0.0), (2.0, 1.0)]


@pytest.mark.parametrize("text, want", [("01/02/2016", "2016-02-01"), (" 01/02/2016 ", "2016-02-01"), ("1/2/2016", None), ("", None), (None, None), ("31/02/2016", None)])
def test_parse_date(spark, text, want):
    found = one(spark, C.parse_date, text)
    assert (found and str(found)) == want


def test_sanitised_names_stay_apart():
    assert C.sanitised(["A&B", "AB", "avg(x/y)", "&"]) == ["AB", "AB_2", "avgxy", "_"]


@pytest.mark.parametrize("f, a, b, want", [
    (S.jaccard_chars, "abc", "abd", 0.5), (S.jaccard_chars, "", "", 0.0), (S.jaccard_chars, "a", None, None), (S.jaccard_chars, "ab", "ba", 0.0),
    (S.jaccard_ngrams_chars, "abcd", "abce", 2 / 3), (S.jaccard_ngrams_chars, "ab", "ab", 0.0), (S.jaccard_ngrams_chars, "ab", "abc", 1.0),
    (S.jaccard_tokens, "a b", "b c", 2 / 3), (S.jaccard_ngrams_tokens, "a b c d", "a b c", 0.5), (S.jaccard_ngrams_tokens, "a", "b", 0.0),
    (S.sorensen, "abc", "abd", 1 / 3), (S.sorensen, "", "", 0.0), (S.edit_distance, "kitten", "sitting", 3),
])
def test_native_metrics(spark, f, a, b, want):
    assert one(spark, f, a, b) == (pytest.approx(want) if want is not None else None)


def test_ratios():
    assert S.percent("abcd", "bcde") == 75
    assert S.percent("", "") == 100
    assert S.partial_percent("abc", "xxabcxx") == 100
    assert S.partial_percent("", "a") == 0
    assert S.token_sort_percent("new york mets", "mets york new") == 100
    assert S.token_set_percent("new york mets", "new york mets vs braves") == 100
    assert S.levenshtein_ratio("abc", "abd") == pytest.approx(4 / 6)
    assert S.levenshtein_ratio("", "") == 1
    assert S.jaro_winkler("martha", "marhta") == pytest.approx(0.9611, abs=1e-4)
    assert S.jaro_winkler("dixon", "dicksonx") == pytest.approx(0.8133, abs=1e-4)
    assert S.jaro_winkler("abc", "xyz") == 0


def test_battery_adds_a_column_per_method_and_keeps_nulls(spark):
    df = spark.createDataFrame([("Ab", "aB"), ("x", None)], "a string, b string")
    scored = S.score_pairs(df, "a", "b")
    assert scored.columns == ["a", "b", *S.BATTERY]
    same, null = sorted(scored.collect(), key=repr)
    assert same.fuzz_ratio == 100 and same.edit_distance == 0 and same.sequencematcher == 1
    assert null.pyjaro is None and null.fuzz_ratio is None


def test_pairs_scored_once_equal_pairs_scored_each(spark):
    df = spark.createDataFrame([("Ab", "aB", 1), ("ab", "AB", 2), ("x", None, 3), (None, None, 4), ("x", "y", 5)], "a string, b string, k int")
    assert rows(S.score_pairs(df, "a", "b", distinct=True)) == rows(S.score_pairs(df, "a", "b"))
