"""Whitespace, numeric coercion, accents and mojibake (FIXTURES C5, C8, C15, C16)."""

import unicodedata

from pyspark.sql import functions as F

from alertfold.functions import text as X


def col(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("s"))).collect()]


def test_normalize_ws_matches_python_whitespace(spark):
    import re
    samples = ["  a b​c\t\td\n", "　x y\x1cz ", "", None, "plain"]
    want = [None if s is None else re.sub(r"\s+", " ", re.sub("[ ​]", " ", s)).strip() for s in samples]
    assert col(spark, samples, X.normalize_ws) == want


def test_c8_to_numeric(spark):
    assert col(spark, ["nan", "1d", "Infinity", "1,5", " 5 ", "1e3", "-2.5", ".5", None], X.to_numeric) == \
        [None, None, None, None, 5.0, 1000.0, -2.5, 0.5, None]


def test_c15_mojibake(spark):
    vals = ["RÃ©fÃ©rence", "Référence", "a€", "plain", "PrioritÃ©"]
    assert col(spark, vals, X.repair_mojibake) == ["Référence", "Référence", "a€", "plain", "Priorité"]
    assert [X.repair_mojibake_name(v) for v in vals] == ["Référence", "Référence", "a€", "plain", "Priorité"]
    assert col(spark, ["Référence €"], lambda c: X.repair_mojibake(X.make_mojibake(c))) == ["Référence €"]


def test_c16_accents(spark):
    assert X.strip_accents_name("Référence") == "Reference"
    assert X.strip_accents_name("Année") == "Annee"
    text = "".join(chr(c) for c in range(0x20, 0x250) if unicodedata.category(chr(c))[0] != "C")
    want = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()
    assert col(spark, [text], X.strip_accents) == [want]


def test_strip_accents_equals_nfkd_everywhere(spark):
    texts = ["Tiếng oﬃce ™ … Ａ", "é ß½⑩ ﬁ\n①", "日本", "", None, "plain"]
    texts += ["".join(chr(c) for c in range(lo, lo + 300) if not 0xD800 <= c <= 0xDFFF) for lo in range(0x80, 0x30000, 4001)]
    df = spark.createDataFrame([(x,) for x in texts], "x string")
    for r in df.select("x", X.strip_accents(F.col("x")).alias("y")).collect():
        assert r.y == (None if r.x is None else unicodedata.normalize("NFKD", r.x).encode("ascii", "ignore").decode())
