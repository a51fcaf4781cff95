"""Attention of a symbol that only the isolation forest flags."""

import random

from pyspark.sql import functions as F

from sessionloom.operators import features as FT
from sessionloom.operators import signals as G
from sessionloom.plans import research
from tests.helpers import day, panel


def test_attention_by_forest_alone(spark, monkeypatch):
    rng, closes = random.Random(3), [100.0]
    while len(closes) < 319:
        closes.append(closes[-1] * (1 + rng.uniform(-0.004, 0.004)))
    closes.append(closes[-1] * 1.006)
    last = F.col("session_date") == F.lit(day(len(closes) - 1))
    calm = panel(spark, [*closes[:-1], closes[-2]], "B")
    busy = F.when(last, 185).otherwise(90 + F.pmod(F.xxhash64("session_date"), F.lit(20)))
    odd = panel(spark, closes, "A").withColumn("volume", busy.cast("long"))
    table = FT.features(odd.unionByName(calm)).cache()
    monkeypatch.setattr(research, "_features", lambda spark, sf: table)
    flags = {r["symbol"]: r for r in research.sg_07(spark, "").collect()}
    others = {r["symbol"]: r for r in G.risk_table(table, forest=False).collect()}
    assert flags["A"]["isolation_anomaly"] and not others["A"]["attention"]
    got = {r["symbol"]: r["attention"] for r in research.sg_08(spark, "").collect()}
    assert got == {s: bool(others[s]["attention"] or flags[s]["isolation_anomaly"]) for s in others} and got["A"]
