import unicodedata
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cardloom.functions import text, values


def told(spark, column, rows, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r[0] for r in df.select(column(F.col("x")).alias("y"), "i").orderBy("i").collect()]


@pytest.mark.parametrize(
    ("column", "cases"),
    [
        (values.date_or_null, {"2024-01-05": date(2024, 1, 5), "20240105": date(2024, 1, 5), "2024-1-5": None, "2024-13-01": None, "2024": None, "": None, None: None}),
        (values.integer_or_null, {"12": 12, " 12 ": 12, "12.0": None, "abc": None, "": None, None: None, "0": 0, " 7": 7}),
        (values.price_or_null, {"1,5": Decimal("1.5000"), " 2 ": Decimal("2.0000"), "0": None, "0,00": None, "1,234.5": None, "abc": None, "": None, "0.00001": Decimal("0.0000"), "1234567890": None, None: None}),
        (text.text_or_null, {" a ": "a", " ": None, "": None, None: None, "\tx\n": "x"}),
        (text.normalize_name, {"Lim-Dûl": "lim-dul", "Fire // Ice": "fire // ice", " É ": "e", "é": "e", "ﬁ": "ﬁ", "Æther": "æther", "한국 각": "\u1112\u1161\u11ab\u1100\u116e\u11a8 \u1100\u1161\u11a8", None: None}),
        (text.compatible_name, {"ﬁ": "fi", " É ": "e", None: None}),
    ],
)
def test_conversions(spark, column, cases):
    assert told(spark, column, list(cases)) == list(cases.values())


def test_every_character_is_taken_apart(spark):
    df = spark.range(0x80, 0x30000).filter("id < 55296 or id >= 57344").repartition(4)
    chars = df.select(F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("c"))
    wrong = []
    for r in chars.select("c", text.normalize_name(F.concat(F.lit("a"), "c", F.lit("b"))).alias("y")).toLocalIterator():
        plain = "".join(x for x in unicodedata.normalize("NFD", f"a{r.c}b") if unicodedata.category(x) != "Mn")
        # of characters that Python does not know, the JVM may know the lower case
        if r.y != plain.lower() and plain.lower() == plain and unicodedata.category(r.c) != "Cn":
            wrong.append(r.c)
    assert wrong == []


def test_first_present_key_wins_even_if_null(spark):
    rows = [{"avg": None, "Avg": "1"}, {"Avg": "1"}, {}]
    assert told(spark, lambda m: values.first_present(m, ["avg", "Avg"]), rows, "map<string,string>") == [None, "1", None]
