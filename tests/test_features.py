import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_workforce import ORG, PERSON, org, person

from musterline.operators import features as FE
from musterline.operators import models, reports
from musterline.plans.bindings import POLICY


@pytest.fixture(scope="module")
def table(spark, bound, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("features") / "t")
    FE.org_features(bound.orgs(), bound.people(), bound.alerts(), POLICY).write.parquet(path)
    return spark.read.parquet(path)


def test_features_of_one_person_and_of_none(spark):
    orgs = spark.createDataFrame([org(1, tier="Platinum"), org(2, tier="Red")], ORG)
    people = spark.createDataFrame([person(1, salary=10), person(2, org_id=None)], PERSON)
    alerts = spark.createDataFrame([], "alert_id int, org_id int, severity string")
    got = {r["org_id"]: r for r in FE.org_features(orgs, people, alerts).collect()}
    assert (got[1]["employee_count"], got[1]["salary_std"], got[1]["avg_salary"]) == (1, None, 10.0)
    assert (got[1]["total_alerts"], got[1]["at_risk"], got[2]["at_risk"]) == (0, 0, 1)
    assert got[2]["employee_count"] is None


def test_std_matches_the_built_in(bound, table):
    want = bound.people().groupBy("org_id").agg(F.stddev_samp("salary").alias("want"))
    off = table.join(want, "org_id").filter(F.abs(F.col("salary_std") - F.col("want")) > 1e-6 * F.col("want"))
    assert off.count() == 0


def test_codes_are_alphabetical(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    assert rows(FE.encode(df, ["c"])) == [("b", 1.0), ("a", 0.0), (None, 2.0)]


def test_hash_split_is_stable(table):
    a, b = (sorted(rows(FE.split(table, "org_id"), "org_id", "is_test")) for _ in range(2))
    assert a == b and 0.1 < sum(t for _, t in a) / len(a) < 0.3


@pytest.mark.parametrize("slices", [1, 7, 1024])
def test_stratified_split_is_exact(spark, slices):
    df = spark.range(1000).withColumn("label", F.when(F.col("id") < 700, "hot").when(F.col("id") < 995, "mid").otherwise("rare"))
    marked = FE.stratified_split(df, "id", "label", 0.2, slices=slices)
    got = dict(rows(marked.groupBy("label").agg(F.count_if("is_test").alias("n")).select("label", "n")))
    assert got == {"hot": 140, "mid": 59, "rare": 1} and marked.count() == 1000


def test_class_weights(spark):
    df = spark.createDataFrame([(1,)] * 3 + [(0,)], "y int")
    got = {r["y"]: (r["balanced_weight"], r["rest_ratio"]) for r in FE.class_weights(df, "y").collect()}
    assert got == {1: (4 / 6, 1 / 3), 0: (2.0, 3.0)}


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,), (None,)], "v double")
    got = rows(reports.histogram(df, "v", 2), "bin", "count", "mean")
    assert got == [(0, 1, 5.0), (1, 2, 5.0)]
    same = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert sum(r[0] for r in rows(reports.histogram(same, "v", 4), "count")) == 2


def test_counts_leave_out_nulls_and_crosstab_fills_zero(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y"), (None, "y")], "k string, v string")
    assert rows(reports.value_counts(df, "k")) == [("a", 2, 66.7), ("b", 1, 33.3)]
    assert ("b", 0, 1, 0) in rows(reports.crosstab(df, "k", "v", ["x", "y"]))
    assert reports.mean_by(spark.createDataFrame([("a", 1.0), ("b", 0.5)], "k string, v double"), "k", "v").first()["k"] == "b"


def test_tier_model(table):
    fitted = models.fit_tier_model(table, trees=20, depth=6)
    report = models.classification_report(fitted).collect()
    assert report[0]["accuracy"] > 0.5
    assert sum(r["support"] for r in report) == fitted.tested.count() == models.confusion(fitted).agg(F.sum("rows")).first()[0]
    ranked = rows(fitted.importances())
    assert {r[0] for r in ranked} == set(models.TIER_FEATURES) and sum(r[1] for r in ranked) == pytest.approx(1)
    assert ranked[0][1] == max(r[1] for r in ranked)
    assert fitted.tested.filter(~F.col("predicted_tier").isin(*POLICY.tiers)).count() == 0


def test_boosted_models(bound, table):
    rate = models.regression_report(models.fit_rate_model(table, trees=5, depth=3), "rate").first()
    assert rate["rows"] > 0 and rate["rmse"] == pytest.approx(rate["mse"] ** 0.5) and rate["mae"] < 0.3
    fitted = models.fit_risk_model(table, trees=5, depth=3)
    scored = models.risk_probabilities(fitted, table)
    assert scored.count() == table.count()
    assert scored.filter("risk_probability < 0 or risk_probability > 1").count() == 0
    by_sector = reports.mean_by(scored, "sector", "risk_probability")
    assert by_sector.count() == 5 and by_sector.filter("mean < 0 or mean > 1").count() == 0
    report = models.classification_report(fitted, "at_risk").collect()
    # Better than naming the larger class for every one of the few dozen test rows.
    assert report[0]["accuracy"] > max(r["support"] for r in report) / sum(r["support"] for r in report)
    salary = models.regression_report(models.fit_salary_model(bound.people(), bound.orgs(), trees=2, depth=3), "salary").first()
    assert salary["rows"] > 0 and salary["r2"] < 1


def test_segments(table):
    got = models.segment(table, k=3, elbow=(2, 3, 4), restarts=2)
    assert got.elbow[2] >= got.elbow[3] >= got.elbow[4] > 0
    profile = models.segment_profiles(got.rows)
    assert profile.count() == 3 and profile.agg(F.sum("orgs")).first()[0] == table.count()
    again = models.segment(table, k=3, elbow=(), restarts=2)
    assert again.centres.cost == pytest.approx(got.centres.cost)
    mixed = reports.crosstab(got.rows, "cluster", "size", POLICY.sizes)
    assert mixed.count() == 3
    points = models.project2d(got.rows)
    assert points.filter("pc1 is null or pc2 is null").count() == 0
    spread = points.agg(F.var_samp("pc1"), F.var_samp("pc2")).first()
    assert spread[0] >= spread[1] > 0


def test_crosstab_counts_unlisted_values_apart(spark):
    from musterline.operators import reports

    df = spark.createDataFrame([("s", "a"), ("s", "Giant"), ("s", None), ("t", "a")], "sector string, size string")
    got = {r["sector"]: r.asDict() for r in reports.crosstab(df, "sector", "size", ("a", "b")).collect()}
    assert got == {"s": {"sector": "s", "a": 1, "b": 0, "other": 2}, "t": {"sector": "t", "a": 1, "b": 0, "other": 0}}


def test_statistics_of_fractions(spark):
    from musterline.operators import reports

    df = spark.createDataFrame([("k", 0.2), ("k", 0.9), ("b", 4e9), ("b", 4e9 + 1)], "k string, v double")
    got = {r["k"]: (r["mean"], r["std"]) for r in reports.describe_by(df, "k", "v", 4).collect()}
    assert got == {"k": (0.55, 0.495), "b": (4000000000.5, 0.7071)}


def test_codes_do_not_depend_on_what_is_scored(spark, bound):
    from musterline.operators import features, models

    table = features.org_features(bound.orgs(), bound.people(), bound.alerts())
    fitted = models.fit_risk_model(table, trees=3, depth=3)
    whole = {r["org_id"]: r["risk_probability"] for r in models.risk_probabilities(fitted, table).collect()}
    alone = models.risk_probabilities(fitted, table.filter("sector = 'MACHINERY'")).collect()
    assert alone and all(whole[r["org_id"]] == r["risk_probability"] for r in alone)


def test_salary_trees_read_equal_people_once(spark, monkeypatch):
    from pyspark.ml.regression import GBTRegressor

    from musterline.operators import models

    orgs = spark.createDataFrame([org(i, sector=f"S{i % 3}") for i in range(6)], ORG)
    people = spark.createDataFrame([person(i, org_id=i % 6, salary=(i * 37) % 101 + 40 * (i % 6), dept=f"D{i % 4}") for i in range(1200)], PERSON)
    seen, real = [], GBTRegressor.fit

    def counted(self, rows):
        seen.append((rows.count(), rows.rdd.getNumPartitions()))
        return real(self, rows)

    monkeypatch.setattr(GBTRegressor, "fit", counted)
    fitted = models.fit_salary_model(people, orgs, trees=4, depth=4)
    assert seen == [(12, 1)]  # 6 organisations, of two departments each
    # The trees are those grown from every person.
    parts = fitted.model.stages
    marked = models.FE.split(models.FE.hash_codes(people.join(orgs.select("org_id", "sector", "size", "region"), "org_id"), models.SALARY_OPEN, "_enc"), "person_id")
    ready = parts[1].transform(parts[0].transform(models._filled(marked.filter("not is_test"), fitted.given)))
    alone = real(GBTRegressor(labelCol="salary", maxIter=4, maxDepth=4, stepSize=0.1, seed=42), ready)
    got, want = (sorted(rows(m.transform(ready), "person_id", "prediction")) for m in (parts[-1], alone))
    assert [k for k, _ in got] == [k for k, _ in want] and len({p for _, p in got}) > 6
    assert [p for _, p in got] == pytest.approx([p for _, p in want])
