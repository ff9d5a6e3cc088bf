"""Sketched medians lie within their bound, and an increment reads only itself."""

import numpy as np
from pyspark.sql import functions as F

from assayer.operators import sketches
from assayer.operators.staging import fill_medians


def batch(spark, name, values):
    rows = [(name, None if v is None else float(v), None) for v in values]
    return spark.createDataFrame(rows, "batch string, x double, empty double").repartition(3)


def test_medians_of_all_batches(spark, tmp_path):
    random, path = np.random.default_rng(5), str(tmp_path / "states")
    parts = [random.exponential(size=n) for n in (20_000, 5_000, 300)]
    for i, part in enumerate(parts):
        states = sketches.keep_states(sketches.quantile_states(batch(spark, f"b{i}", part), ["x", "empty"], "batch"), path)
    row = sketches.sketched_medians(states).first()
    everything = np.sort(np.concatenate(parts))
    rank = np.searchsorted(everything, row["median"]) / len(everything)
    assert (row.column_name, row.batches, row.n) == ("x", 3, len(everything)) and states.count() == 3
    assert abs(rank - 0.5) <= sketches.rank_error() < 0.003
    # A batch that comes again takes the place of its earlier states.
    again = sketches.keep_states(sketches.quantile_states(batch(spark, "b0", [9.0] * 20_000), ["x"], "batch"), path)
    assert sketches.sketched_medians(again).first()["median"] == 9.0 and again.count() == 3
    filled = fill_medians(batch(spark, "n", [None, 1.0]), sketches.median_values(again))
    assert sorted(r.x for r in filled.collect()) == [1.0, 9.0]


def test_gaps_ties_and_no_rows(spark):
    rows = batch(spark, None, [None, float("nan"), 2.0, 2.0, 2.0])
    state = sketches.quantile_states(rows, ["x", "empty"], "batch")
    assert [(r.column_name, r.n, r.batch) for r in state.collect()] == [("x", 3, "")]
    assert sketches.median_values(state) == {"x": 2.0}
    none = sketches.quantile_states(rows.where(F.lit(False)), ["x"], "batch")
    assert none.collect() == [] and sketches.median_values(none) == {}
