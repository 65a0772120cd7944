"""Ordered bits of doubles and the exact quartiles built on them."""

import math
import random
import struct

import numpy as np
from pyspark.sql import functions as F

from stayflow.functions.ordering import leading, ordered_bits
from stayflow.operators import profile

TINY = 5e-324


def bits_of(value):
    size = struct.unpack(">q", struct.pack(">d", abs(value)))[0]
    return -size if value < 0 else size


def odd_doubles():
    rng = random.Random(4)
    values = [0.0, -0.0, 1.0, -1.0, TINY, -TINY, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308]
    values += [math.inf, -math.inf]
    for e in range(-1074, 1024, 7):
        p = math.ldexp(1.0, e)
        values += [p, -p, math.nextafter(p, 0.0), math.nextafter(p, math.inf)]
    values += [struct.unpack(">d", rng.randbytes(8))[0] for _ in range(5000)]
    return [v for v in values if not math.isnan(v)]


def test_bits_are_those_of_the_double(spark):
    values = odd_doubles()
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", ordered_bits(F.col("v")).alias("b")).collect()
    assert [(r.v, r.b) for r in rows if r.b != bits_of(r.v)] == []
    odd = spark.createDataFrame([(math.nan,), (None,)], "v double").select(ordered_bits(F.col("v")).alias("b")).collect()
    assert odd[0].b > bits_of(math.inf) and odd[1].b is None


def test_leading_bits_keep_the_order(spark):
    values = sorted(odd_doubles())
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", leading(ordered_bits(F.col("v")), 16).alias("b"))
    parts = [r.b for r in sorted(df.collect(), key=lambda r: r.v)]
    assert parts == sorted(parts) and len(set(parts)) > 1000


def numbers(seed, rows=3000):
    rng = random.Random(seed)
    kinds = [
        lambda: rng.randrange(5),
        lambda: rng.gauss(0, 1e6),
        lambda: rng.choice([None, 7.25]),
        lambda: None,
        lambda: math.exp(rng.gauss(0, 40)) * rng.choice([-1, 1]),
        lambda: 1.0 + rng.randrange(40) * 2**-52,  # told apart by the last bits only
    ]
    return [(rng.choice(["a", "a", "b", None]), *[float(v) if (v := k()) is not None else None for k in kinds]) for _ in range(rows)]


def check(rows, data, names):
    for r in rows:
        mine = [d[1 + names.index(r.metric)] for d in data if "g" not in r.asDict() or d[0] == r.g]
        known = [v for v in mine if v is not None]
        assert r["count"] == len(known)
        if not known:
            assert [r[s] for s in profile.STATISTICS[1:]] == [None] * 7
            continue
        assert (r["min"], r["max"]) == (min(known), max(known))
        for name, q in profile.QUARTILES.items():
            assert math.isclose(r[name], np.quantile(known, q), rel_tol=1e-12, abs_tol=1e-300)
        assert math.isclose(r["mean"], np.mean(known), rel_tol=1e-9, abs_tol=1e-9)
        if len(known) > 1:
            assert math.isclose(r["std"], np.std(known, ddof=1), rel_tol=1e-9, abs_tol=1e-12)
        else:
            assert r["std"] is None


def test_describe_is_exact_in_all_groups_with_either_join(spark):
    names = [f"c{i}" for i in range(6)]
    data = numbers(9)
    df = spark.createDataFrame(data, "g string, " + ", ".join(f"{n} double" for n in names)).repartition(7)
    rows = profile.describe(df, names).collect()
    assert len(rows) == 6
    check(rows, data, names)
    for max_groups in (profile.MAX_GROUPS, 2):
        rows = profile.describe(df, names, by="g", max_groups=max_groups).collect()
        assert len(rows) == 18
        check(rows, data, names)


def test_describe_of_few_rows_and_none(spark):
    for data in ([("a", 3.5)], [("a", 3.5), ("a", None)], [("a", 1.0), ("a", 2.0), ("b", 5.0)]):
        df = spark.createDataFrame(data, "g string, c double")
        check(profile.describe(df, ["c"], by="g").collect(), data, ["c"])
    none = spark.createDataFrame([], "g string, c double")
    assert profile.describe(none, ["c"]).count() == 0


def test_describe_plan_is_small(spark):
    """One aggregate per scan, whatever the number of columns."""
    def exchanges(width):
        df = spark.range(100).select(*[(F.col("id") * i).alias(f"c{i}") for i in range(width)])
        plan = profile.describe(df)._jdf.queryExecution().executedPlan().toString()
        return plan.count("Exchange hashpartitioning"), plan.count("HashAggregate")
    assert exchanges(2) == exchanges(40)
