"""Repeated keys by the seen-once / seen-twice filter: against a plain count, with few places and small packs."""

import random
from collections import Counter

import numpy as np
import pytest

from nestgate.functions import rules as R
from nestgate.operators import seen_twice as S
from nestgate.plans import validate as V


def test_packs_round_trip():
    r = np.random.default_rng(1)
    for n, top in [(0, 1), (1, 1), (1, 1 << 40), (1000, 1 << 40), (1000, 2000), (999, 70_000)]:
        places = np.unique(r.integers(0, top, n))
        pack = S.packed(places)
        assert (S.unpacked(pack) == places).all()
    dense = np.unique(r.integers(0, 1 << 40, 200_000))
    assert len(S.packed(dense)) < 4 * len(dense)          # places, not keys


@pytest.mark.parametrize("bits,held", [(40, 1 << 21), (6, 50), (1, 7)])
def test_against_a_plain_count(spark, monkeypatch, bits, held):
    """Few places make every key a suspect; the counts stay exact."""
    monkeypatch.setattr(S, "PLACE_BITS", bits)
    monkeypatch.setattr(S, "HELD", held)
    r = random.Random(bits)
    rows = [(r.choice([None, r.randrange(400)]), r.choice([None, "a", "b"]), 0.0) for _ in range(500)]
    rows += [(7, "hot", 1.0)] * 300 + [(1000 + i, "once", 2.0) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, `a.b` string, v double").repartition(6)
    got = {(x["k"], x["a.b"]): x["n"] for x in S.repeated_keys(df, ["k", "a.b"], "n").collect()}
    assert got == {k: n for k, n in Counter((a, b) for a, b, _ in rows).items() if n > 1}


def test_zeros_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([(0.0, None), (-0.0, None), (None, 0), (None, 1), (float("nan"), 2), (float("nan"), 2)],
                               "v double, w int")
    rows = S.repeated_keys(df, ["v", "w"], "n").collect()
    assert len(rows) == 2 and {x["n"] for x in rows} == {2}
    assert S.repeated_keys(df.where("w > 9"), ["v"], "n").count() == 0
    assert V.summary(df, [R.unique("u", "v")]).first()["failed"] == 6


def test_unique_keys_stay_out_of_the_exchange(spark):
    """The filter's exchange carries packs; only rows on suspect places reach the exact count."""
    df = spark.range(20_000).selectExpr("concat('a long key with many letters ', id) as k").unionByName(
        spark.createDataFrame([("twice",)] * 2, "k string"))
    plan = S.suspect_places(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(range" in plan and plan.count("Exchange") == 1
    exact = S.repeated_keys(df, ["k"], "n")
    text = exact._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in text and "BroadcastHashJoin" in text and text.count("Exchange hashpartitioning(k") == 1
    assert [tuple(x) for x in exact.collect()] == [("twice", 2)]
    assert S.suspect_places(df, ["k"]).count() < 10
