"""Many terms at once against ``in`` and against CASE."""

import random

from pyspark.sql import functions as F

from packloom.operators import terms


def test_five_thousand_terms(spark):
    rnd = random.Random(3)
    word = lambda n: "".join(rnd.choice("abcéß ") for _ in range(n))
    given = [word(rnd.randint(2, 7)) for _ in range(5000)] + ["", "ABC", "Σ", "abc"]
    texts = [word(rnd.randint(0, 300)).upper() for _ in range(200)] + [None, "", "σοφος", word(20_000)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(3)
    got = {r.i: r.f for r in frame.select("i", terms.terms_in(F.col("t"), given).alias("f")).collect()}
    assert got == {i: None if t is None else [x.casefold() for x in given if x.casefold() in t.casefold()] for i, t in enumerate(texts)}


def test_first_label_is_the_case(spark):
    rules = {"boiler": ["heat", "boil"], "pump": ["PUMP", "flow"], "none": []}
    frame = spark.createDataFrame([("Pump and heater",), ("overflow",), ("OVERFLOW boil",), ("door",), ("",), (None,)], "t string")
    case = F.when(F.lower("t").contains("heat") | F.lower("t").contains("boil"), "boiler").when(F.lower("t").contains("pump") | F.lower("t").contains("flow"), "pump")
    rows = frame.select(terms.first_label(F.col("t"), rules).alias("a"), case.alias("b"), terms.first_label(F.col("t"), {}).alias("c")).collect()
    assert [r.a for r in rows] == [r.b for r in rows] == ["boiler", "pump", "boiler", None, None, None] and {r.c for r in rows} == {None}
