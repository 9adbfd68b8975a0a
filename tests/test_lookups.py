import pytest
from conftest import rows
from pyspark.sql import functions as F

from musterline.operators import lookups as L
from musterline.plans import sql_functions
from musterline.plans.bindings import AS_OF, POLICY


@pytest.fixture(scope="module")
def tables(spark, bound):
    frames = {"orgs": bound.orgs(), "people": bound.people(), "rules": bound.rules(), "alerts": bound.alerts()}
    for name, df in frames.items():
        df.createOrReplaceTempView(f"t_{name}")
    sql_functions.register(spark, {k: f"t_{k}" for k in frames}, AS_OF, POLICY)
    return frames


def same(spark, sql, df):
    got = spark.sql(sql)
    assert got.columns == df.columns
    a, b = rows(got), rows(df)
    assert a == b and a


def test_functions_equal_their_frames(spark, tables):
    o, p, r, a = (tables[k] for k in ("orgs", "people", "rules", "alerts"))
    same(spark, "SELECT * FROM org_status('#00000001')", L.org_status(o, "#00000001", POLICY))
    same(spark, "SELECT * FROM orgs_in_tier('mid green')", L.orgs_in_tier(o, "mid green"))
    same(spark, "SELECT * FROM sector_summary('u') ORDER BY 1", L.sector_summary(o, "u", POLICY).orderBy("sector"))
    same(spark, "SELECT * FROM expiring_nationals('#', 200)", L.expiring_nationals(p, o, "#", 200, AS_OF, POLICY))
    same(spark, "SELECT * FROM org_alerts('#00000000')", L.org_alerts(a, "#00000000", policy=POLICY))
    same(spark, "SELECT * FROM overall_summary()", L.overall_summary(o, POLICY))
    same(spark, "SELECT * FROM tier_thresholds('BUILD', 'small')", L.tier_thresholds(r, "BUILD", "small", POLICY))
    for target in ("Platinum", "high green", "MidGreen", "low_green", "nonsense"):
        same(spark, f"SELECT * FROM hires_needed('#00000002', '{target}')", L.hires_needed(o, r, "#00000002", target, POLICY))
    same(
        spark,
        "SELECT * FROM simulate_change('#00000002', 1, 2, 3, 4)",
        L.simulate_change(o, r, "#00000002", 1, 2, 3, 4, POLICY).drop("tier_impact", "pct_change"),
    )
    same(spark, "SELECT * FROM org_people('#00000001')", L.org_people(p, o, "#00000001", policy=POLICY))
    same(spark, "SELECT * FROM list_orgs()", L.list_orgs(o, POLICY))


@pytest.mark.parametrize("spelling", ["high_green", "High Green", "HIGH_GREEN", "High_Green"])
def test_tier_spellings_agree(spark, tables, spelling):
    want = tables["orgs"].filter("tier = 'High_Green'").count()
    assert spark.sql("SELECT * FROM orgs_in_tier(:t)", args={"t": spelling}).count() == want > 0


def test_name_parameter_is_not_hidden_by_a_column(spark, tables):
    everything = tables["alerts"].count()
    some = spark.sql("SELECT * FROM org_alerts('#000000001')").count()
    assert 0 < some < everything
    assert spark.sql("SELECT * FROM org_alerts('no such name')").count() == 0


def test_parameters_are_values_not_text(spark, tables):
    assert spark.sql("SELECT * FROM org_status(:n)", args={"n": "x' OR '1'='1"}).count() == 0


def test_optional_filters(tables):
    a = tables["alerts"]
    assert L.org_alerts(a).count() == a.count()
    assert L.org_alerts(a, severity="High").count() == a.filter("severity = 'High'").count()
    assert L.org_alerts(a, unread_only=True).count() == a.filter("not is_read").count()
    order = [r["severity"] for r in L.org_alerts(a).collect()]
    assert order == sorted(order, key=["High", "Medium", "Low"].index)


def test_zero_days_is_a_filter(tables):
    p, o = tables["people"], tables["orgs"]
    today = p.withColumn("contract_end", F.lit(AS_OF))
    assert L.org_people(today, o, "#", expiring_days=0, as_of=AS_OF, policy=POLICY).count() == p.count()
    assert L.org_people(p, o, "#", expiring_days=0, as_of=AS_OF, policy=POLICY).filter(F.col("contract_end") != AS_OF).count() == 0


def test_people_lookup(spark, tables):
    p, o = tables["people"], tables["orgs"]
    want = p.join(o.filter("contains(name, '#00000001')").select("org_id"), "org_id").select("person_id")
    assert sorted(rows(L.people_of(p, o, "#00000001"), "person_id")) == sorted(rows(want))
    assert L.people_of(p, o.unionByName(o), "#00000001").count() == want.count()
    assert L.people_of(p, o, "nobody").count() == 0


def test_compare_takes_first_on_ties(spark, tables):
    same_rate = tables["orgs"].withColumn("rate", F.lit(0.5))
    got = rows(L.compare(same_rate, ["#000000002", "#000000001"], POLICY), "position", "name", "best_performer", "worst_performer")
    assert {r[2] for r in got} == {r[3] for r in got} == {"Customer#000000002"}
    assert L.compare(tables["orgs"], ["nobody"], POLICY).count() == 0


def test_lateral_call_and_unknown_sector(spark, tables, bound):
    got = spark.sql("SELECT n.v, s.org_id FROM VALUES ('#000000001'), ('#000000002') AS n(v), LATERAL org_status(n.v) s")
    assert sorted(rows(got)) == [("#000000001", 1), ("#000000002", 2)]
    assert L.sector_profile(tables["orgs"], bound.benchmarks(), "none", POLICY).count() == 0
    assert L.sector_profile(tables["orgs"], bound.benchmarks(), "MACHINERY", POLICY).first()["trend"] is None


def test_registered_in_a_database(spark, bound):
    spark.sql("CREATE DATABASE IF NOT EXISTS tools_src")
    spark.sql("CREATE DATABASE IF NOT EXISTS tools")
    names = {}
    for k in ("orgs", "people", "rules", "alerts"):
        names[k] = f"tools_src.{k}"
        getattr(bound, k)().write.mode("overwrite").saveAsTable(names[k])
    sql_functions.register(spark, names, AS_OF, POLICY, db="tools")
    other = spark.newSession()
    other.sql("USE tools")
    assert other.sql("SELECT * FROM overall_summary()").first()["orgs"] == bound.orgs().count()
    listed = {r[0].split(".")[-1] for r in rows(sql_functions.list_functions(spark, "tools"))}
    assert {"org_status", "hires_needed", "list_orgs"} <= listed
