import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from msgrisk.constants import MANUAL_FEATURES
from msgrisk.functions import text
from msgrisk.functions.text import capital_ratio, normalized, preprocess, safe_text, truncated

MESSAGES = {
    1: "Vietcombank: tài khoản bị khóa! Click http://bit.ly/abc để xác nhận OTP",
    2: "Gọi 0912 345 678 nhận 5 triệu",
    3: "see microsoft.com in 5 minutes",
    4: "ALL CAPS 123456789!!",
    5: None,
    6: "été à là",
    7: "Tin của_bạn là bit.ly/x  và   ngay",
    8: "FREE free Click www.a.vn/b 100k +84 912-345-678",
}
FLAGS = {  # url, short, phone, money, account, bank, keywords, !, capital part, words
    1: (1, 1, 0, 0, 0, 1, 4, 1, 0, 11),
    2: (0, 0, 1, 1, 0, 0, 0, 0, 0, 7),
    3: (0, 1, 0, 1, 0, 0, 0, 0, 0, 5),
    4: (0, 0, 0, 0, 1, 0, 0, 2, 1, 3),
    5: (0, 0, 0, 0, 0, 0, 0, 0, 0, 0),
    6: (0, 0, 0, 0, 0, 0, 0, 0, 0, 3),
    7: (0, 1, 0, 0, 0, 0, 0, 0, 0, 6),
    8: (1, 0, 0, 1, 0, 0, 3, 0, 0, 7),
}
CAPS = {1: 0.2407, 2: 0.3333, 3: 0, 4: 1, 5: 0, 6: 0.6667, 7: 0.2174, 8: 0.2381}
NORMAL = {
    1: "vietcombank tài khoản bị khóa click [URL] để xác nhận otp",
    2: "gọi [PHONE] nhận [MONEY]",
    3: "see microsof [SHORTURL] in [MONEY] inutes",
    4: "all caps 123456789",
    5: "",
    6: "été à là",
    7: "tin của bạn là [SHORTURL] và ngay",
    8: "free free click [URL] [MONEY] 84 912 345 678",
}
CLEAN = {**{k: v.lower() for k, v in NORMAL.items()}, 6: "été à", 7: "tin bạn [shorturl] ngay"}
COUNTS = {1: 11, 2: 4, 3: 6, 4: 3, 5: 0, 6: 2, 7: 4, 8: 9}


@pytest.fixture(scope="module")
def prepared(spark):
    df = spark.createDataFrame(list(MESSAGES.items()), "msg_id int, text string")
    ratio = F.round(capital_ratio(safe_text(F.col("text"))), 4).alias("caps")
    rows = preprocess(normalized(df).withColumn("caps", ratio)).collect()
    return {r.msg_id: r for r in rows}


@pytest.mark.parametrize("i", MESSAGES)
def test_message(prepared, i):
    row = prepared[i]
    assert row.normalized == NORMAL[i]
    assert row.clean_text == CLEAN[i]
    assert row.token_count == COUNTS[i]
    assert tuple(row[f] for f in MANUAL_FEATURES) == FLAGS[i]
    assert row.caps == pytest.approx(CAPS[i])


def one(spark, text):
    return preprocess(normalized(spark.createDataFrame([(text,)], "text string"))).first()


def test_decomposed_letters_split_words_only_for_vectors(spark):
    import unicodedata

    row = one(spark, unicodedata.normalize("NFD", MESSAGES[1]))
    assert unicodedata.normalize("NFC", row.normalized) == NORMAL[1]


def test_whitespace_of_every_kind(spark):
    row = one(spark, " a b c d\x1ce　")
    assert row.normalized == "a b c d e" and row.msg_length == 5


@pytest.mark.parametrize("text, words", [("", 0), (" ", 0), ("x", 1), (" x ", 1), ("x\n\ny", 2)])
def test_word_count(spark, text, words):
    assert one(spark, text).msg_length == words


def test_ratio_above_one_keeps_its_integer_part(spark):
    # Two signs that the capital range takes in though they are no letters, and one letter.
    assert one(spark, "×÷A").capslock_ratio == 3.0


@pytest.mark.parametrize("text, money", [("1.2.3k", 1), ("12.34 x", 0), ("9" * 5000, 0), ("7 ,5 usd", 1)])
def test_money(spark, text, money):
    assert one(spark, text).has_money == money


@pytest.mark.parametrize("text, account", [("1234567", 0), ("x12345678", 0), ("12345678901234567890", 1),
                                           ("123456789012345678901", 0), ("(12345678)", 1)])
def test_account(spark, text, account):
    assert one(spark, text).has_bank_account == account


def test_truncated(spark):
    df = spark.createDataFrame([("a\nb" + "x" * 10,), ("a\nb",)], "t string")
    assert [r[0] for r in df.select(truncated(F.col("t"), 5)).collect()] == ["a bxx...", "a b"]


def test_missing_column(spark):
    with pytest.raises(KeyError):
        preprocess(spark.range(1))


def test_cheap_looks_come_before_costly_steps(spark):
    """Words are not cut out to be counted, and odd characters give what the plain definitions give."""
    texts = ["", " ", "　a b \x1c", "AÀ", "ÀÉ", "Àé a", "à́", "é̀́̂", "×× a", "otp OTPotp free", "trúng thưởng",
             "ſ.id x", "S.ID", "T.CO/x", "+84 912 345 678", "84912345678", "x0912345678", "nothing"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {r.i: r for r in text.message_features(df).collect()}
    for i, t in enumerate(texts):
        capitals = sum("A" <= c <= "Z" or "À" <= c <= "Ỹ" for c in t)
        letters = sum(unicodedata.category(c)[0] == "L" for c in t)
        assert got[i].capslock_ratio == (capitals // letters if letters else 0), t
        assert got[i].msg_length == len(re.split(f"[{SPACES}]+", t.strip(SPACES))) - (not t.strip(SPACES)), t
    assert [got[i].fraud_keyword_count for i in (9, 10, 17)] == [4, 1, 0]
    assert [got[i].has_shorturl for i in range(11, 14)] == [1, 1, 1]
    assert [got[i].has_phone for i in range(14, 17)] == [0, 1, 1]
    plan = text.message_features(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan and "(?=[+80])" in plan and "(?=[bgst])" in plan


SPACES = "\t\n\x0b\x0c\r \x85\xa0     　\x1c\x1d\x1e\x1f" + "".join(map(chr, range(0x2000, 0x200b)))
