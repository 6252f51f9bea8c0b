"""The split join against a plain lookup, with and without heavy keys."""

import random

import pytest
from pyspark.sql import functions as F

from inkline.llm import attach as A
from inkline.llm.scratch import written


@pytest.mark.parametrize("light", [0, 20, 10**6])
def test_attach_equals_lookup(spark, monkeypatch, light):
    monkeypatch.setattr(A, "LIGHT", light)
    monkeypatch.setattr(A, "HEAVY", 10)
    rnd = random.Random(light)
    rows = [(i, rnd.choice(["hot", "hot", "hot", None, "b", f"k{i}"]), i % 2 or None) for i in range(400)]
    df = written(spark.createDataFrame(rows, "i long, k string, j long"), "t")
    table = written(df.filter("i % 7 > 0").groupBy("k", "j").agg(F.count(F.lit(1)).alias("n"), F.sum("i").alias("total")), "t")
    known = {(r.k, r.j): r.total for r in table.collect()}
    out = A.attach(df, table, ["k", "j"], "n")
    assert out.columns == ["i", "k", "j", "total"]
    assert [(r.i, r.total) for r in out.orderBy("i").collect()] == [(i, known.get((k, j))) for i, k, j in rows]
    assert ("Union" in out._jdf.queryExecution().optimizedPlan().toString()) == (light < 10**6)
    assert A.attach(df, table.limit(0), ["k", "j"], "n").filter("total IS NULL").count() == 400
