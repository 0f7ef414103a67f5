"""Exact quantiles against numpy's."""

import numpy as np
import pytest

from smoothway.operators import quantiles

SHARES = (0.0, 0.1, 0.5, 0.77, 0.95, 1.0)


@pytest.mark.parametrize("ranges", [1, 7])
def test_quantiles_of_skewed_and_tied_values(spark, ranges):
    rng = np.random.default_rng(2)
    values = {"same": [4.0] * 300, "hot": [0.0] * 200 + rng.normal(size=150).tolist(), "one": [7.5], "two": [1.0, 2.0], "wide": rng.normal(size=501).tolist(), "none": []}
    rows = [(k, v) for k, own in values.items() for v in own] + [("none", None), ("wide", None)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = quantiles.exact_quantiles(spark.createDataFrame(rows, "name string, amount double").repartition(3), SHARES).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    told = {(r["name"], r["share"]): r["quantile"] for r in found}
    assert set(told) == {(k, q) for k in values if values[k] for q in SHARES}
    for (k, q), v in told.items():
        assert v == pytest.approx(np.quantile(values[k], q), abs=1e-12)
