import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from musterline.operators import gold, planning, silver
from musterline.plans.bindings import AS_OF, POLICY
from musterline.policy import Policy

P = Policy()
ORG = (
    "org_id int, name string, registration_no string, sector string, size string, region string, total int, "
    "nationals int, non_nationals int, rate double, tier string, registration_date date, last_updated timestamp"
)
PERSON = (
    "person_id int, org_id int, nationality string, job_title string, department string, salary int, "
    "contract_type string, hire_date date, contract_end date, is_remote boolean, gender string"
)
RULES = "sector string, size string, platinum_pct double, high_green_pct double, mid_green_pct double, low_green_pct double"
DAY = dt.date(2000, 1, 1)


def org(i, total=10, nat=3, tier="Low_Green", name="n", sector="S", size="Small"):
    rate = None if not total else nat / total
    return (i, name, f"CR{i}", sector, size, "R", total, nat, (total or 0) - (nat or 0), rate, tier, DAY, None)


def person(i, org_id=1, nat="Saudi", salary=4000, end=None, dept="d", title="t"):
    return (i, org_id, nat, title, dept, salary, "Permanent", DAY - dt.timedelta(731), end, False, "Male")


@pytest.fixture()
def make(spark):
    return lambda data, schema: spark.createDataFrame(data, schema)


@pytest.mark.parametrize(
    "offset, want",
    [
        (None, "No End Date"),
        (-1, "Expired"),
        (0, "Expiring Soon"),
        (29, "Expiring Soon"),
        (30, "Expiring in 90 Days"),
        (89, "Expiring in 90 Days"),
        (90, "Active"),
    ],
)
def test_contract_edges(make, offset, want):
    end = None if offset is None else DAY + dt.timedelta(offset)
    got = silver.person_clean(make([person(1, end=end)], PERSON), DAY).first()
    assert got["contract_status"] == want
    assert got["tenure_days"] == 731 and got["tenure_years"] == 2.0


def test_null_values_fall_into_the_default_buckets(make):
    got = silver.person_clean(make([person(1, nat=None, salary=None)], PERSON), DAY).first()
    assert got["is_national"] is False and got["salary_band"] == "Executive"
    o = silver.org_clean(make([org(1, total=None, nat=None, tier=None)], ORG), DAY).first()
    assert (o["headcount_bucket"], o["compliance_status"], o["rate_pct"]) == ("500+", "Non-Compliant", None)


def test_rows_without_keys_are_left_out_and_text_is_trimmed(make):
    orgs = make([org(None), org(2, name="  x ")], ORG)
    assert rows(silver.org_clean(orgs, DAY), "org_id", "name") == [(2, "x")]
    people = make([person(None), person(1, org_id=None), person(3)], PERSON)
    assert rows(silver.person_clean(people, DAY), "person_id") == [(3,)]


def test_audit_column_only_with_a_clock(make):
    now = dt.datetime(2020, 1, 1)
    assert "processed_at" not in silver.org_clean(make([org(1)], ORG), DAY).columns
    assert silver.org_clean(make([org(1)], ORG), DAY, now=now).first()["processed_at"] == now


def test_gap_without_rule_is_unknown_and_two_rules_fan_out(make):
    orgs = silver.org_clean(make([org(1), org(2, sector="none")], ORG), DAY)
    rules = make([("S", "Small", 50.0, 40.0, 35.0, 20.0), ("S", "Small", 60.0, 50.0, 40.0, 30.0)], RULES)
    got = {(r["org_id"], r["mid_green_pct"]): r for r in silver.org_gap(orgs, rules, P).collect()}
    assert set(got) == {(1, 35.0), (1, 40.0), (2, None)}
    assert got[(1, 35.0)]["hires_for_next_tier"] == 1 and got[(1, 35.0)]["gap_to_platinum"] == 20.0
    assert got[(2, None)]["hires_for_next_tier"] is None and got[(2, None)]["next_tier"] == "Mid_Green"


def test_gap_is_not_clamped_and_guards_a_full_threshold(make):
    orgs = silver.org_clean(make([org(1, nat=9, tier="Red"), org(2, tier="High_Green"), org(3, tier=None)], ORG), DAY)
    rules = make([("S", "Small", 100.0, 40.0, 35.0, 20.0)], RULES)
    got = {r["org_id"]: r for r in silver.org_gap(orgs, rules, P).collect()}
    assert got[1]["hires_for_next_tier"] == -8
    assert got[2]["hires_for_next_tier"] is None and got[2]["next_tier"] == "Platinum"
    assert got[3]["next_tier"] == "Low_Green"


def test_attrition_levels(make):
    orgs = silver.org_clean(make([org(1, tier="Mid_Green"), org(2, tier="Red"), org(3, total=0, nat=0)], ORG), DAY)
    soon, later = DAY + dt.timedelta(5), DAY + dt.timedelta(60)
    people = silver.person_clean(
        make(
            [
                person(1, end=soon),
                person(2, end=later),
                person(3),
                person(4, org_id=2),
                person(5, nat="X", end=soon),
                person(6, org_id=3),
                person(7, org_id=99),
            ],
            PERSON,
        ),
        DAY,
    )
    got = {r["person_id"]: (r["risk_level"], r["rate_pct_if_leaves"]) for r in silver.attrition_risk(people, orgs, P).collect()}
    assert got == {
        1: ("Critical", 20.0), 2: ("High", 20.0), 3: ("Low", 20.0), 4: ("Medium", 20.0), 5: ("Low", 30.0), 6: ("Medium", None),
    }


def test_summary_keeps_orgs_without_people(make):
    orgs = silver.org_clean(make([org(1), org(2)], ORG), DAY)
    people = silver.person_clean(make([person(1, salary=1), person(2, salary=2, dept="e"), person(3, nat="X", salary=None)], PERSON), DAY)
    got = {r["org_id"]: r for r in silver.org_people_summary(orgs, people).collect()}
    assert got[2]["people"] is None
    one = got[1]
    assert (one["people"], one["avg_salary"], one["avg_other_salary"], one["departments"]) == (3, 2.0, None, 2)


def test_risk_counts_agree_with_and_without_the_join(bound):
    people = silver.person_clean(bound.people(), AS_OF, POLICY)
    orgs = silver.org_clean(bound.orgs(), AS_OF, POLICY)
    a = gold.risk_counts(silver.attrition_risk(people, orgs, POLICY))
    b = gold.risk_counts_from_people(people)
    assert sorted(rows(a)) == sorted(rows(b))


def test_risk_score_points_and_zero_fill(make):
    orgs = silver.org_clean(make([org(1, tier="Red", nat=0), org(2, tier="Mid_Green")], ORG), DAY)
    gap = silver.org_gap(orgs, make([("S", "Small", 50.0, 40.0, 35.0, 29.5)], RULES), P)
    counts = make([(1, 7, 0, 0)], "org_id int, critical_people bigint, high_people bigint, national_expiring_30d bigint")
    alerts = make([(1, "High", False)] * 3 + [(2, "High", False), (2, "High", True)], "org_id int, severity string, is_read boolean")
    got = {r["org_id"]: r for r in gold.risk_score(gap, counts, alerts, P).collect()}
    assert (got[1]["risk_score"], got[1]["risk_category"]) == (100.0, "Critical")
    assert (got[2]["risk_score"], got[2]["risk_category"], got[2]["critical_people"], got[2]["active_alerts"]) == (20.0, "Medium", 0, 1)


def test_dashboard_of_nothing(make):
    orgs = silver.org_clean(make([], ORG), DAY)
    gap = silver.org_gap(orgs, make([], RULES), P)
    counts = make([], "org_id int, critical_people bigint, high_people bigint, national_expiring_30d bigint")
    alerts = make([], "org_id int, severity string, is_read boolean")
    got = gold.exec_dashboard(gold.risk_score(gap, counts, alerts, P), DAY).first()
    assert (got["orgs"], got["overall_rate_pct"], got["avg_risk_score"], got["report_date"]) == (0, 0.0, 0.0, "2000-01-01")


def test_shares_sum_to_the_whole(bound):
    gap = silver.org_gap(silver.org_clean(bound.orgs(), AS_OF, POLICY), bound.rules(), POLICY)
    kpi = gold.kpi_tier(gap, POLICY)
    assert [r["tier"] for r in kpi.collect()] == list(POLICY.tiers)
    assert kpi.agg(F.sum("pct_of_total")).first()[0] == pytest.approx(100, abs=0.3)


def test_duplicate_org_rows_stay_one_group(make):
    orgs = silver.org_clean(make([org(1), org(1)], ORG), DAY)
    people = silver.person_clean(make([person(1), person(2)], PERSON), DAY)
    assert rows(gold.department_share(people, orgs), "people", "national_people") == [(4, 4)]


def test_hires_reach_target_and_unknown_targets(bound):
    orgs = silver.org_clean(bound.orgs(), AS_OF, POLICY)
    plan = planning.hires_to_target(orgs, bound.rules(), None, POLICY)
    assert plan.filter("projected_rate_pct + 0.005 < target_pct").count() == 0
    assert plan.count() == orgs.count() * 4
    unknown = planning.hires_to_target(orgs, bound.rules(), "Gold", POLICY)
    assert rows(unknown.select("target_pct").distinct()) == [(25.0,)]
    none = planning.hires_to_target(orgs.withColumn("sector", F.lit("?")), bound.rules(), "Mid_Green", POLICY)
    assert rows(none.select("hires").distinct()) == [(0,)]


def test_plan_ends_at_the_target(bound):
    hires = planning.hires_to_target(silver.org_clean(bound.orgs(), AS_OF, POLICY), bound.rules(), "Platinum", POLICY)
    plan = planning.hiring_plan(hires, capacity=2, salary=10)
    last = plan.filter("month = months_to_complete")
    assert last.filter("cumulative_hires <> total_hires OR cumulative_payroll <> total_hires * 10").count() == 0
    assert plan.filter("hires_this_month < 1 OR hires_this_month > 2").count() == 0
    summed = plan.groupBy("org_id", "total_hires").agg(F.sum("hires_this_month").alias("s"))
    assert summed.filter("s <> total_hires").count() == 0
    docs = planning.plan_documents(hires, capacity=2, salary=10)
    flat = docs.select("org_id", "target_tier", "months_to_complete", "total_hires", "annual_cost", F.inline("monthly_plan"))
    assert sorted(rows(flat, *plan.columns)) == sorted(rows(plan))


def test_what_if_edges(make):
    orgs = silver.org_clean(make([org(1, total=4, nat=1, tier="Yellow")], ORG), DAY)
    rules = make([("S", "Small", 50.0, 40.0, 35.0, 29.5)], RULES)
    cases = [
        {"scenario": "none"},
        {"scenario": "all leave", "nat_leaves": 9, "other_leaves": 9},
        {"scenario": "up", "nat_hires": 2},
    ]
    got = {r["scenario"]: r for r in planning.what_if(orgs, rules, cases, P).collect()}
    assert (got["none"]["tier_impact"], got["none"]["rate_impact"], got["none"]["pct_change"]) == ("NO_CHANGE", "NO_CHANGE", 0.0)
    gone = got["all leave"]
    assert (gone["new_total"], gone["new_rate_pct"], gone["projected_tier"], gone["tier_impact"]) == (0, 0.0, "Red", "DOWNGRADE")
    assert (got["up"]["projected_tier"], got["up"]["rate_impact"]) == ("Platinum", "IMPROVEMENT")


def test_top_hires_breaks_ties_by_id(make):
    df = make([(i, "x" * 30, "Red", 5) for i in range(20)], "org_id int, name string, current_tier string, hires bigint")
    got = rows(planning.top_hires(df, 3))
    assert [r[0] for r in got] == [0, 1, 2] and len(got[0][1]) == 20


def test_no_change_is_reported_as_none(spark, bound):
    from musterline.operators import planning, silver
    from musterline.plans.bindings import AS_OF, POLICY

    orgs = silver.org_clean(bound.orgs(), AS_OF, POLICY)
    idle = planning.what_if(orgs, bound.rules(), [{"scenario": "idle"}], POLICY)
    assert {r[0] for r in rows(idle, "rate_impact")} == {"NO_CHANGE"}


def test_head_counts_decide_on_hires(spark):
    from musterline.operators import planning

    df = spark.createDataFrame([(25_000, 6_999, 28.0, 28.0)], "total int, nationals int, rate_pct double, target_pct double")
    assert rows(planning.with_hires(df), "hires") == [(2,)]
