"""Cleaning functions against the reference rules, incl. Unicode edge cases."""

import html
import unicodedata
from html.entities import html5

import pytest
from pyspark.sql import functions as F

from polarity.functions import text as tx
from polarity.functions.accents import strip_accents, stripped
from polarity.functions.html import decode_html_entities
from tests import patterns as py

def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "t string").select(expr(F.col("t")).alias("o")).first()[0]


def many(spark, values, expr):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string") \
        .select("i", expr(F.col("t")).alias("o")).collect()
    return [r.o for r in sorted(rows, key=lambda r: r.i)]


def test_entities_decode_as_python_does(spark):
    cases = ["fish &amp; chips", "&lt;-- &#39;q&#39;", "na&iuml;ve &copy;&middot;", "&amp without end", "nothing", "&notit;",
             "&#0;", "p & q", "&&amp;", "&#", "&#x41;", "&#X4a", "& #38;", "x&\ty", "&\rz", "&;", "tail &", "", "&amp;lt;",
             "&" + "a" * 40 + ";", "&\U0001f600;", "&CounterClockwiseContourIntegralx;", "&lt&gt", "&#99999999999999999999;"]
    for name in html5:                                   # every name: whole, inside a word, cut short, run on
        cases += ["&" + name, f"a&{name}b", "&" + name[:-1], f"&{name.rstrip(';')}xyz;"]
    numbers = [*range(0x180), 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDCF, 0xFDD0, 0xFDEF, 0xFDF0, 0xFFFD, 0xFFFE, 0xFFFF, 0x10000, 0x1FFFE,
               0x1F600, 0x10FFFD, 0x10FFFF, 0x110000, 99_999_999, 10 ** 12]
    cases += [form % n for n in numbers for form in ("&#%d;", "x&#%dz", "&#x%x;", "&#X%X", "&#0000000000%d;")]
    assert many(spark, cases, decode_html_entities) == [html.unescape(c) for c in cases]
    assert many(spark, [None, "x"], decode_html_entities) == [None, "x"]


def test_links_mentions_and_tags_follow_their_patterns(spark):
    links = ["see http://a.b/c?d=e#f, then WWW.Q.R", "httpx://no www", "ftp://h www.", "HTTPS://Z"]
    assert many(spark, links, tx.replace_urls) == [py.URL.sub("<URL>", c) for c in links]
    names = ["by @kim_9 & @lee", "a@b", "@a@b", "@@x", "é@x", "@xé", "x @y_1!", "@ alone", "é@y"]
    assert many(spark, names, tx.replace_mentions) == [py.MENTION.sub("<USER>", c) for c in names]
    tags = ["#rain#sun", "# not", "#café #x²", "a#b_1-c"]
    assert many(spark, tags, tx.clean_hashtags) == [py.HASHTAG.sub(r"\1", c) for c in tags]


def test_runs_of_space_become_one(spark):
    cases = ["\n one \t\r two  ", "three", " \u00a0 \u3000", "a\x1cb"]
    assert many(spark, cases, tx.normalize_whitespace) == [py.SPACES.sub(" ", c).strip() for c in cases]


def test_whitespace_class_matches_python(spark):
    chars = [chr(c) for c in range(0x3001) if not 0xD800 <= c <= 0xDFFF]
    values = [f"a{c}{c}b{c}" for c in chars]
    got = many(spark, values, tx.normalize_whitespace)
    want = [py.SPACES.sub(" ", v).strip() for v in values]
    assert [v for v, g, w in zip(values, got, want) if g != w] == []


def test_signs_and_emoji_survive_cleaning(spark):
    cases = ["wow... @me?! #yes \U0001f680 www.go.to/x", "(\u2764) @a; #b, http://c"]
    assert many(spark, cases, tx.clean_text) == ["wow... <USER>?! yes \U0001f680 <URL>", "(\u2764) <USER>; b, <URL>"]


def test_clean_and_key_unicode_cases(spark):
    cases = ["x\u00b2 y\u0301 z", "\U0001f469\u200d\U0001f4bb @dev", "a \u2003 b", "a\x1cb", "\t\t",
             "salt &amp; pepper   &AMP; #tag", "ÉCOLE  &eacute;t&eacute;", "ΑΣ ΣΑΣ", "\u0130stanbul"]
    assert many(spark, cases, tx.clean_text) == [
        "x\u00b2 y\u0301 z", "\U0001f469\u200d\U0001f4bb <USER>", "a b", "a b", "", "salt & pepper & tag", "ÉCOLE été", "ΑΣ ΣΑΣ",
        "\u0130stanbul"]
    assert many(spark, cases, tx.duplicate_key) == [
        "x\u00b2 y\u0301 z", "\U0001f469\u200d\U0001f4bb @dev", "a b", "a b", "", "salt & pepper & #tag", "école été", "ας σας",
        "i\u0307stanbul"]


def test_clean_flags(spark):
    flags = tx.CleaningFlags(normalize_whitespace=False, replace_urls=False)
    assert one(spark, "  a  www.x.y \t", lambda c: tx.clean_text(c, flags)) == "a  www.x.y"


def test_word_count_and_blank(spark):
    assert many(spark, ["", "  ", "a b\tc", " x "], tx.word_count) == [0, 0, 3, 1]
    assert many(spark, ["", " \t　", "a", None], tx.is_blank) == [True, True, False, None]


def test_strip_accents_matches_rule_for_every_character(spark):
    chars = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c <= 0xDFFF]
    cases = ["café", "naïve ﬁancé", "한국어", "½ x²", "ǅ", "plain", "ÀÉÎÕÜ", "𝐀𝐁", "á", "", None]
    cases += ["a" + "".join(chars[i:i + 50]) + "z" for i in range(0, len(chars), 50)]
    assert many(spark, cases, strip_accents) == [c if c is None else stripped(c) for c in cases]
    assert stripped("é") == "e" and unicodedata.combining("\u0301")


def test_text_plans_hold_no_python(spark, sf_small):
    from polarity.operators import dedup, features as feat
    from polarity.sources import fixtures as fx
    posts = fx.posts(spark, sf_small)
    for df in (posts.select(tx.clean_text("text")), posts.select(tx.preprocess_for_terms("text", True, "unicode")),
               dedup.preprocess_plan(posts).clean, feat.doc_terms(posts, feat.BASELINE_TFIDF, "text")):
        assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_char_wb_ngrams_rule(spark):
    cases = ["a bb ccc dddd eeeee", "x", "", "héllo  wörld\tok", "ab", "\U0001f600x ab\u00a0cd"]
    for rng in [(3, 5), (1, 2), (2, 4), (4, 4)]:
        got = many(spark, cases, lambda c: tx.char_wb_ngrams(c, rng))
        assert [sorted(g) for g in got] == [sorted(py.boundary_grams(c, *rng)) for c in cases], rng


def test_word_ngrams_and_term_counts(spark):
    df = spark.createDataFrame([(1, "the cat the cat sat"), (2, "")], "row_id long, t string")
    out = tx.with_terms(df, "t", "terms", "word", (1, 2))
    out = tx.with_term_counts(out, "terms", "counts").orderBy("row_id").collect()
    assert out[0].terms == ["the", "cat", "the", "cat", "sat", "the cat", "cat the", "the cat", "cat sat"]
    assert {(e.term, e.tf) for e in out[0].counts} == {("the", 2), ("cat", 2), ("sat", 1), ("the cat", 2),
                                                       ("cat the", 1), ("cat sat", 1)}
    assert out[1].counts == []


def test_ngram_range_must_have_two_items():
    with pytest.raises(ValueError, match="two-item"):
        tx.word_ngrams(F.col("x"), (1, 2, 3))
