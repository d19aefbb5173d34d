from datetime import datetime

from pyspark.sql import functions as F

from caseweave.functions import text as X
from caseweave.operators import brand as B


def test_validate_records(spark):
    rows = [(101, "115712", "@AppleSupport the lamp stays dark"), (101, "115712", None), (102, "115712", " \t "),
            (None, "115712", "Help"), (103, None, "Help"), (104, "  ", "Help")]
    df = spark.createDataFrame(rows, "tweet_id long, author_id string, text string")
    assert [r.tweet_id for r in B.validate_records(df).collect()] == [101]


def test_cleaning_keeps_voice(one):
    raw = "@AppleSupport teh lamp wont lite??? 🔦🙃 since 5pm @ home"
    values = [raw, "@applesupport\n\nhi", "@AppleSupportUK hi", "hi @AppleSupport", "@AppleSupport", None, "", "a\x00\x0bb� \t c"]
    got = one(lambda c: X.clean_customer_text(c, "@AppleSupport"), values)
    assert got == [raw[14:], "hi", "UK hi", "hi @AppleSupport", "", "", "", "ab c"]


def test_brand_handle_is_escaped(one):
    assert one(lambda c: X.clean_customer_text(c, "@a.b"), ["@a.b x", "@axb x"]) == ["x", "@axb x"]


def test_reply_cleaning(one):
    values = ["@77 Tell us the colour of the lamp.", "@käse_1  hi", "no @name here", "@ alone", None]
    assert one(X.clean_brand_reply, values) == ["Tell us the colour of the lamp.", "hi", "no @name here", "@ alone", ""]


def test_dates(one):
    values = ["Tue Oct 31 22:08:27 +0000 2017", "Tue Oct 31 22:08:27 +0200 2017", "2017-10-31", "nonsense", None,
              "Tue Oct 41 22:08:27 +0000 2017"]
    got = one(lambda c: F.date_format(X.parse_created_at(c), "yyyy-MM-dd HH:mm:ss"), values)
    assert got == ["2017-10-31 22:08:27", "2017-10-31 20:08:27", None, None, None, None]
    assert datetime.strptime(values[0], "%a %b %d %H:%M:%S %z %Y").minute == 8


def test_parent_id_and_words(one):
    assert one(X.parent_id, [3.0, None], "double") == [3, None]
    assert one(X.word_count, ["a  b c", "", " ", None, "x"]) == [3, 0, 0, 0, 1]


def test_extract_and_dedup(spark):
    rows = [(1, "u", True, "hello @BRAND"), (2, "brand", False, "hi"), (3, "Other", False, "x @brand"),
            (4, "u", True, "@brandUK"), (5, "u", True, None), (1, "u", True, "again @brand"), (None, "u", True, "no")]
    df = spark.createDataFrame(rows, "tweet_id long, author_id string, inbound boolean, text string")
    subset = B.extract_brand(df, "Brand")
    assert sorted(r.tweet_id for r in subset.collect()) == [1, 1, 2, 4]
    assert sorted((r.tweet_id, r.text) for r in B.dedup_tweets(subset).collect()) == [
        (1, "again @brand"), (2, "hi"), (4, "@brandUK")]
    try:
        B.require_rows(B.extract_brand(df, "nobody"), "nobody")
        assert False
    except ValueError:
        pass


def test_all_brands(spark):
    rows = [(1, "u", True, "@One and @two @ONE"), (2, "One", False, "x"), (3, "Two", False, "y"), (4, "u", True, "@three")]
    df = spark.createDataFrame(rows, "tweet_id long, author_id string, inbound boolean, text string")
    got = sorted((r.brand, r.tweet_id) for r in B.extract_all_brands(df).collect())
    assert got == [("One", 1), ("One", 2), ("Two", 1), ("Two", 3)]
