"""Quantiles and histograms against NumPy, edge cases of the profile and diagnostic queries."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from faresift import schema as S
from faresift.functions.scalars import half_even
from faresift.operators import diagnostics as D
from faresift.operators import profiling
from faresift.operators import quantiles as quantile_steps
from faresift.operators.quantiles import approx_quantiles, key_value, quantiles, ranked_values, with_key
from trip_rows import FLEX, lasting

POINTS = [0.0, 0.001, 0.25, 0.5, 0.75, 0.995, 1.0]
SAMPLES = {
    "normal": lambda r: r.normal(0, 50, 5000),
    "wide": lambda r: np.exp(r.normal(0, 40, 3000)) * r.choice([-1, 1], 3000),
    "one hot value": lambda r: np.where(r.random(4000) < 0.6, 2.5, np.round(r.normal(0, 3, 4000), 2)),
    "clustered": lambda r: 1000 + r.random(3000) * 1e-9,
    "tiny and zero": lambda r: np.array([0.0, -0.0, 5e-324, -5e-324, 1e-300, 1.0]),
    "single": lambda r: np.array([7.25]),
    "extreme": lambda r: np.array([1.7e308, -1.7e308, 0.0, 1.0]),
}


@pytest.mark.parametrize("name", SAMPLES)
def test_quantiles_are_exact(spark, name):
    values = SAMPLES[name](np.random.default_rng(5))
    df = spark.createDataFrame(pd.DataFrame({"x": values})).repartition(4)
    found = {r["probability"]: r["quantile"] for r in quantiles(df, {"x": POINTS}).collect()}
    if name == "extreme":
        points = [0.0, 1.0]
    else:
        points = POINTS
        assert set(found) == set(POINTS)
    for p in points:
        assert found[p] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-300), p


def test_quantiles_skip_missing_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,), (float("nan"),)], "x double")
    assert [r["quantile"] for r in quantiles(df, {"x": [0.5]}).collect()] == [2.0]
    assert quantiles(df.where("x is null"), {"x": [0.5]}).count() == 0


def test_weighted_quantiles_per_group(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": rng.integers(0, 5, 4000), "value": rng.integers(-50, 50, 4000) / 4})
    counted = spark.createDataFrame(pdf).groupBy("g", "value").agg(F.count(F.lit(1)).alias("n"))
    found = ranked_values(counted, ["g"], F.array(F.lit(0.5), F.lit(0.9)), bounded=False, weight="n").collect()
    expected = pdf.groupby("g")["value"].quantile([0.5, 0.9])
    assert len(found) == 10
    for r in found:
        assert r["quantile"] == pytest.approx(expected[r["g"], r["probability"]])


def test_approximate_quantiles_are_close(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("x"))
    assert [r["quantile"] for r in approx_quantiles(df, {"x": [0.25, 0.5]}).collect()] == [250.0, 500.0]


@pytest.mark.parametrize("bins", [1, 7, 100])
@pytest.mark.parametrize("kind", ["cents", "normal", "integers", "same"])
def test_histogram_equals_numpy(spark, kind, bins):
    rng = np.random.default_rng(3)
    values = {
        "cents": np.round(rng.random(4000) * 15, 2),
        "normal": rng.normal(3, 20, 4000),
        "integers": rng.integers(-5, 12, 500).astype(float),
        "same": np.full(9, 4.5),
    }[kind]
    df = spark.createDataFrame(pd.DataFrame({"x": values}))
    found = profiling.histogram(df, "x", bins=bins).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=bins)
    assert [r["count"] for r in found] == counts.tolist()
    assert [r["lower"] for r in found] == pytest.approx(edges[:-1].tolist())
    assert found[-1]["upper"] == edges[-1]


def test_histogram_between_quantiles(spark):
    values = np.random.default_rng(4).normal(0, 1, 3000)
    df = spark.createDataFrame(pd.DataFrame({"x": values}))
    found = profiling.histogram(df, "x", bins=20, low_quantile=0.005, high_quantile=0.995).orderBy("bin").collect()
    low, high = np.quantile(values, [0.005, 0.995])
    counts, _ = np.histogram(values[(values >= low) & (values <= high)], bins=20)
    assert [r["count"] for r in found] == counts.tolist()


@pytest.mark.parametrize(
    ("values", "low", "high", "counts"),
    [([0.0, 5.0, 5.3, 9.0], 5.0, 5.1, [0, 1]), ([0.5, 0.2], 10.0, 20.0, [0, 0]), ([4.0, 4.0, 7.0], 3.0, 5.0, [0, 2])],
)
def test_histogram_counts_only_what_lies_inside_the_limits(spark, values, low, high, counts):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    found = profiling.histogram(df, "x", bins=2, low=low, high=high).orderBy("bin")
    assert [r["count"] for r in found.collect()] == counts
    kept = np.array([v for v in values if low <= v <= high])
    assert counts == np.histogram(kept, bins=2)[0].tolist()


def test_quantiles_of_crowded_values_and_of_whole_numbers_beyond_doubles(spark):
    """Values within a hundredth of a per cent are cut into cells; whole numbers are never doubles on the way."""
    crowd = spark.range(200_000).select((F.lit(1e9) + F.col("id") / 2.0).alias("x"))
    found = {r["probability"]: r["quantile"] for r in quantiles(crowd, {"x": [0.25, 0.5, 1.0]}).collect()}
    assert found == {0.25: 1e9 + 199_999 / 8, 0.5: 1e9 + 199_999 / 4, 1.0: 1e9 + 199_999 / 2}
    big = spark.range(101).select((F.lit(2**60) + F.col("id") * 256).alias("x"))
    assert quantiles(big, {"x": [0.5]}).first()["quantile"] == float(2**60 + 50 * 256)
    near = spark.createDataFrame([(2**53 + 1,), (2**53 + 2,), (2**53 + 2,)], "x bigint")
    assert quantiles(near, {"x": [0.5]}).first()["quantile"] == float(2**53 + 2)


def test_histogram_of_nothing(spark):
    found = profiling.histogram(spark.createDataFrame([(None,)], "x double"), "x", bins=4).orderBy("bin").collect()
    assert [(r["lower"], r["upper"], r["count"]) for r in found] == [(0.0, 0.25, 0), (0.25, 0.5, 0), (0.5, 0.75, 0), (0.75, 1.0, 0)]


def test_half_even_rounds_like_numpy(spark):
    values = np.concatenate([[1.005, 0.00005, 2.5, -0.001, 0.125], np.random.default_rng(2).normal(0, 100, 2000)])
    df = spark.createDataFrame(pd.DataFrame({"x": values}))
    for digits in (2, 4):
        found = df.select("x", half_even(F.col("x"), digits).alias("y")).toPandas()
        assert (found["y"] == found["x"].round(digits)).all()
        assert not np.signbit(found["y"][found["y"] == 0]).any()


def test_describe_matches_pandas(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"a": rng.normal(0, 1, 500), "b": rng.integers(0, 9, 500).astype(float)})
    found = {r["column"]: r for r in profiling.describe_numeric(spark.createDataFrame(pdf), ["a", "b"]).collect()}
    expected = pdf.describe()
    names = {"count": "count", "mean": "mean", "std": "std", "min": "min", "p25": "25%", "p50": "50%", "p75": "75%", "max": "max"}
    for c in pdf:
        for ours, theirs in names.items():
            assert found[c][ours] == pytest.approx(expected[c][theirs])


def test_duration_bins_are_closed_on_the_right_and_complete(trip):
    edges = [0, 1, 360, 1200, 1380, 1440]
    found = profiling.duration_bins(trip(*map(lasting, edges), lasting(1440.01))).collect()
    assert [(r["duration_range"], r["count"]) for r in found] == [(b, 1) for b in S.DURATION_BINS]
    assert [r["count"] for r in profiling.duration_bins(trip(lasting(2))).collect()] == [0, 0, 1, 0, 0, 0, 0]


def test_missing_counts_of_whole_table_is_empty(trip):
    assert profiling.missing_counts(trip({})).count() == 0
    assert profiling.missing_counts(trip({}, FLEX)).count() == 5


def test_period_outliers_of_sound_month(trip):
    from faresift.plans.catalog import _bounds

    row = profiling.period_outliers(trip({}, {S.PICKUP: None}), *_bounds()).first()
    assert tuple(row) == (0, None, None, None)


def test_column_profile_counts_null_as_a_value(trip):
    rows = trip({"extra": None}, {"extra": 1.0}, {"extra": 1.0})
    for approximate in (False, True):
        found = {r["column"]: r for r in profiling.column_profile(rows, approximate).collect()}
        assert set(found) == set(S.TRIP_COLUMNS)
        assert (found["extra"]["missing"], found["extra"]["missing_pct"], found["extra"]["unique_including_na"]) == (1, 33.33, 2)


def test_crosstab_margins_add_up_and_missing_total_is_positive(trip):
    rows = trip({"total_amount": None}, {"total_amount": -1.0}, {"total_amount": 0.0, **FLEX}, {})
    found = {r["record_group"]: r for r in D.record_sign_crosstab(rows).collect()}
    assert tuple(found["standard_group"])[1:] == (1, 0, 2, 3)
    for c in ("negative", "zero", "positive", "All"):
        assert found["All"][c] == found["flex_fare_group"][c] + found["standard_group"][c]
    assert found["All"]["All"] == 4


def test_partial_missing_pattern(trip):
    rows = trip(FLEX, {"passenger_count": None}, {"payment_type": 0}, {})
    found = {r["metric"]: r["value"] for r in D.missing_pattern(rows).collect()}
    assert found["all six conditions"] == 1 and found["some but not all conditions"] == 2


def test_vendor_without_complete_rows_is_kept(trip):
    rows = trip({}, {"total_amount": 14.5}, {"VendorID": 6, **FLEX})
    found = {r["VendorID"]: r for r in D.reconcile_by_vendor(rows).collect()}
    assert tuple(found[6]) == (6, 0, 0, None, None, None)
    assert tuple(found[2]) == (2, 2, 1, 50.0, -1.25, 2.5)


def test_top_residuals_break_ties_by_value(trip):
    rows = trip(*[{"total_amount": 17.0 + i} for i in range(7)], {"total_amount": 20.0})
    found = [(r["amount_residual"], r["count"]) for r in D.top_residuals_by_vendor(rows).orderBy(F.desc("count"), "amount_residual").collect()]
    assert found == [(3.0, 2), (0.0, 1), (1.0, 1), (2.0, 1), (4.0, 1)]


def test_distance_bins_without_a_group(trip):
    found = {r["record_group"]: r for r in D.distance_bins_by_group(trip({"trip_distance": 50.0}, {"trip_distance": 0.0})).collect()}
    assert tuple(found["standard_group"])[1:] == (50.0, 50.0, 0.0, 0.0, 0.0)
    assert set(tuple(found["flex_fare_group"])[1:]) == {None}


def test_duplicates(trip):
    rows = trip(*[{}] * 3, {"extra": 9.0}, {"PULocationID": 1, "RatecodeID": None}, {"PULocationID": 1, "RatecodeID": None})
    assert tuple(D.exact_duplicates(rows).first()) == (5, 3)
    assert tuple(D.business_duplicates(rows).first()) == (6, 4)


def test_zone_checks(trip):
    rows = trip({"PULocationID": 264, "DOLocationID": 265}, {"PULocationID": 0}, {"DOLocationID": 266})
    found = {r["metric"]: r["value"] for r in profiling.zone_range_checks(rows).collect()}
    assert list(found.values()) == [1, 1, 1, 1, 1]
    found = {r["metric"]: r["value"] for r in profiling.location_checks(rows).collect()}
    assert found["PULocationID <= 0"] == 1 and found["PULocationID unique"] == 3 and found["DOLocationID maximum"] == 266


def test_keys_are_the_bits_of_doubles(spark):
    """Every power of two with its neighbours, random bit patterns, least and largest numbers, both signs."""
    rng = np.random.default_rng(4)
    powers = np.ldexp(1.0, np.arange(-1074, 1024))
    patterns = rng.integers(0, 2047 << 52, 4000, dtype=np.int64).view(np.float64)
    sizes = np.concatenate([powers, np.nextafter(powers, 0), np.nextafter(powers, np.inf), patterns, [0.0, np.inf, 1.7976931348623157e308]])
    values = np.concatenate([sizes, -sizes])
    df = spark.createDataFrame([(float(v), float(v)) for v in values] + [(None, None), (float("nan"), 0.0)], "value double, given double")
    keyed = with_key(df, integral=False).withColumn("back", quantile_steps._key_column_value(F.col("key"))).collect()
    assert len(keyed) == len(values)
    for r in keyed:
        assert r["key"] == int(np.copysign(1, r["given"])) * int(np.abs(np.float64(r["given"])).view(np.int64))
        assert r["back"] == key_value(r["key"]) == r["given"]


def test_plans_do_not_grow_with_the_passes(spark, monkeypatch):
    """One scan and two shuffles per digit, three digits at most; limits of a histogram are literals in its plan."""
    plans = []
    step = quantile_steps._pass
    monkeypatch.setattr(quantile_steps, "_pass", lambda *a: plans.append(step(*a)) or plans[-1])
    values = np.random.default_rng(8).normal(0, 1, 20_000)
    df = spark.createDataFrame(pd.DataFrame({"x": values, "y": 1 + values * 1e-12})).repartition(4)
    found = profiling.describe_numeric(df, ["x", "y"], (0.25, 0.5)).collect()
    for r, v in zip(found, (values, 1 + values * 1e-12), strict=True):
        assert [r["p25"], r["p50"]] == pytest.approx(np.quantile(v, [0.25, 0.5]), rel=1e-12)
    assert 2 <= len(plans) <= 3
    for plan in plans:
        text = plan._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
        assert text.count("Exchange hashpartitioning") <= 2 and text.count("Scan ExistingRDD") == 1
    counted = profiling.histogram(df, "x", low_quantile=0.01, high_quantile=0.99)._jdf.queryExecution().executedPlan().toString()
    assert counted.count("Scan ExistingRDD") == 1 and "Subquery" not in counted


def test_ranked_values_keep_null_groups_and_many_digits(spark):
    rng = np.random.default_rng(6)
    rows = [(None if i % 3 == 0 else i % 3, float(v)) for i, v in enumerate(1 + rng.random(3000) * 1e-13)]
    found = ranked_values(spark.createDataFrame(rows, "g int, value double"), ["g"], F.array(F.lit(0.5)), bounded=False).collect()
    expected = {g: float(np.median([v for k, v in rows if k == g])) for g in (None, 1, 2)}
    assert {r["g"]: r["quantile"] for r in found} == pytest.approx(expected, rel=1e-15)


def test_sketches_of_months_unite(spark):
    rng = np.random.default_rng(9)
    rows = [(f"m{i % 3}", int(v), None if i % 5 == 0 else f"t{v % 700}", float(v) / 3) for i, v in enumerate(rng.integers(0, 20_000, 30_000))]
    df = spark.createDataFrame(rows, "source_file string, a long, b string, c double")
    sketches = profiling.profile_sketches(df)
    assert sketches.count() == 9
    exact = {r["column"]: r for r in profiling.column_profile(df.drop("source_file")).collect()}
    months = [profiling.profile_sketches(df.where(F.col("source_file") == m)) for m in ("m0", "m1", "m2")]
    united = profiling.united_profile(months[0].union(months[1]).union(months[2])).collect()
    assert {r["column"]: r["unique_including_na"] for r in united} == {
        r["column"]: r["unique_including_na"] for r in profiling.united_profile(sketches).collect()
    }
    for r in united:
        own = exact[r["column"]]
        assert (r["missing"], r["missing_pct"], r["dtype"]) == (own["missing"], own["missing_pct"], own["dtype"])
        assert abs(r["unique_including_na"] - own["unique_including_na"]) <= 0.03 * own["unique_including_na"]
    one = profiling.united_profile(profiling.profile_sketches(df.withColumn("source_file", F.lit("all")))).collect()
    assert all(abs(a["unique_including_na"] - b["unique_including_na"]) <= 0.03 * b["unique_including_na"] for a in one for b in united if a["column"] == b["column"])
