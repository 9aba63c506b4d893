import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import similarity as S
from tessera.functions import text as X
from tessera.functions.rules import ADDRESS, BUSINESS


def column(spark, values, make):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v string")
    return [r["o"] for r in df.select("k", make(F.col("v")).alias("o")).orderBy("k").collect()]


def test_first_steps(spark):
    given_ = ["Café", "Café", "İstanbul", "Cœur & Straße", "½ Main St", "⑴ Rd", "AT&T", "L.L.C.", "O'Brien's"]
    want = ["cafe", "cafe ", "i stanbul", "cur   strae", "12 main st", "(1) rd", "at t", "l l c ", "o brien s"]
    assert column(spark, given_, lambda c: X.ascii_folded(X.spaced(X.lowered(c)))) == want


def test_folding_is_nfkd(spark):
    codes = [c for c in range(0x80, 0x30000) if not 0xD800 <= c < 0xE000]
    got = column(spark, [chr(c) for c in codes], X.ascii_folded)
    assert got == ["".join(x for x in unicodedata.normalize("NFKD", chr(c)) if x < "\x80") for c in codes]


@pytest.mark.parametrize(
    ("rules", "value", "want"),
    [
        (BUSINESS, "ACME Corp.", "acme corporation"),
        (BUSINESS, "Foo Pvt Ltd", "foo private limited"),
        (BUSINESS, "Foo PvtLtd", "foo private limited"),
        (BUSINESS, "X dba Y", "x y"),
        (BUSINESS, "Dist Co", "distribution company"),
        (ADDRESS, "12 N Main St, Dist 4", "12 north main street district 4"),
        (ADDRESS, "O'Brien's Rd", "o brien south road"),
        (BUSINESS, None, ""),
        (BUSINESS, "", ""),
        (BUSINESS, "देवनागरी", ""),
    ],
)
def test_normalized(spark, rules, value, want):
    assert column(spark, [value], lambda c: X.normalized(c, rules)) == [want]


def test_expander_alone(spark):
    assert column(spark, ["at&t", "a & b", "Foo  Corp., Inc", "", None], X.expand_business_name) == ["atandt", "a & b", "foo corporation., incorporated", "", None]


def test_soundex(spark):
    assert column(spark, ["Ashcraft", "Pfister", "Tymczak", "Jackson", "Sch", "3m", "", None], X.soundex) == ["A226", "P236", "T522", "J250", "S000", "M000", "", ""]


def test_grams(spark):
    assert column(spark, ["ab c", "", None], lambda c: F.array_sort(X.word_grams(F.coalesce(c, F.lit(""))))) == [sorted([" a", "ab", "b ", " ab", "ab ", " ab ", " c", "c ", " c "]), [], []]


def test_parsed_ids(spark):
    assert column(spark, ["", "  ", "S2-1", "S2-1,S3-2", "S2-1, S3-2 ", None], X.parsed_ids) == [[], [], ["S2-1"], ["S2-1", "S3-2"], ["S2-1", "S3-2"], []]


def test_numbers(spark):
    df = spark.createDataFrame([("main st", "oak st"), ("12 main", "main"), ("12 main 4", "12 main 5")], "a string, b string")
    assert [r[0] for r in df.select(S.number_match(F.col("a"), F.col("b"))).collect()] == [-1.0, 0.0, 1 / 3]


def test_ratios():
    assert S.indel_ratio("kitten", "sitting") == 8 / 13
    assert S.lcs_length("kitten", "sitting") == 4
    assert round(S.jaro_winkler("martha", "marhta"), 6) == 0.961111
    assert S.token_sort_ratio("b a", "a b") == 1
    assert S.token_set_ratio("a b", "a b c") == 1
    assert S.partial_ratio("abc", "xxabcxx") == 1
    assert (S.indel_ratio("", ""), S.jaro_winkler("", ""), S.token_set_ratio("", ""), S.partial_ratio("", "")) == (1, 1, 0, 1)


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row = [0, *row[1:]] if False else _step(row, x, b)
    return row[-1]


def _step(row, x, b):
    out = [0]
    for j, y in enumerate(b):
        out.append(row[j] + 1 if x == y else max(row[j + 1], out[j]))
    return out


@settings(max_examples=200, deadline=None)
@given(st.text("abc ", max_size=80), st.text("abc ", max_size=80))
def test_properties(a, b):
    assert S.lcs_length(a, b) == slow_lcs(a, b)
    for f in (S.indel_ratio, S.token_sort_ratio, S.token_set_ratio, S.jaro_winkler, S.partial_ratio):
        assert 0 <= f(a, b) <= 1
    assert S.indel_ratio(a, b) == S.indel_ratio(b, a)
    assert S.token_set_ratio(a, b) == S.token_set_ratio(b, a)
    if a:
        assert S.indel_ratio(a, a) == S.jaro_winkler(a, a) == S.partial_ratio(a, a) == 1
