import datetime as dt

from conftest import rows
from test_workforce import DAY, ORG, PERSON, org, person

from musterline.operators import quality as Q
from musterline.policy import Policy

P = Policy(sectors=("S",))


CHECKS = Q.checks(Q.declaration(DAY, P))


def results(spark, orgs, people, rules=CHECKS):
    tables = {Q.ORGS: spark.createDataFrame(orgs, ORG), Q.PEOPLE: spark.createDataFrame(people, PERSON)}
    return {r["rule_id"]: r for r in Q.validate(tables, rules).collect()}


def test_every_active_check_has_a_result(spark):
    got = results(spark, [org(1)], [person(1)])
    assert set(got) == {c.id for c in CHECKS} and all(r["status"] == "PASSED" for r in got.values())
    assert all(r["passed_records"] + r["failed_records"] == r["total_records"] for r in got.values())


def test_inactive_checks_are_skipped(spark):
    from dataclasses import replace

    rules = [replace(c, is_active=c.id == "organisations.name.present") for c in CHECKS]
    assert set(results(spark, [org(1)], [person(1)], rules)) == {"organisations.name.present"}


def test_failures_are_counted(spark):
    bad = list(org(1))
    bad[9] = 0.9  # rate
    bad[8] = 99  # non-nationals
    orgs = [tuple(bad), org(1), org(2, sector="?", tier="?"), org(None), org(4, name=None)]
    late = list(person(2))
    late[7] = DAY + dt.timedelta(1)
    people = [person(1, org_id=77), tuple(late), person(2, salary=1), person(None, org_id=None, nat=None)]
    got = {k: r["failed_records"] for k, r in results(spark, orgs, people).items() if r["failed_records"]}
    assert got == {
        "organisations.org_id.present": 1, "people.person_id.present": 1, "organisations.name.present": 1,
        "people.nationality.present": 1, "organisations.sector.listed": 1, "organisations.tier.listed": 1,
        "people.salary.within": 1, "people.hire_date.within": 1, "organisations.total.agrees": 1,
        "organisations.rate.agrees": 1, "people.org_id.known": 2, "organisations.org_id.single": 2,
        "people.person_id.single": 2,
    }


def test_nulls_are_judged_by_presence_alone(spark):
    got = results(spark, [org(1, sector=None, tier=None, total=0, nat=0)], [person(1, salary=None)])
    quiet = ("organisations.sector.listed", "organisations.tier.listed", "people.salary.within", "organisations.rate.agrees")
    assert {got[k]["failed_records"] for k in quiet} == {0}


def test_empty_tables(spark):
    got = results(spark, [], [])
    assert len(got) == len(CHECKS) and all(r["total_records"] == 0 and r["status"] == "PASSED" for r in got.values())


def test_one_declaration_gives_rules_and_expectations(spark):
    names = {e.name for t in (Q.ORGS, Q.PEOPLE) for e in Q.expectations(CHECKS, t)}
    assert names == {c.id for c in CHECKS if c.by_row}
    every = Q.Valid("v", required=True, among=("a",), least=1, most=2, agrees="v = w", key=True, known_in="t").checks("x")
    assert [c.part for c in every] == list(Q.PARTS)


def test_orphans_include_null_keys(spark):
    people = spark.createDataFrame([person(1), person(2, org_id=9), person(3, org_id=None)], PERSON)
    orgs = spark.createDataFrame([org(1)], ORG)
    assert sorted(rows(Q.orphans(people, orgs, "org_id"), "person_id")) == [(2,), (3,)]


def test_expectations_warn_drop_and_null(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "v int")
    warn = Q.Expectation("positive", "v > 0")
    kept, seen = Q.check(df, [warn])
    assert kept.count() == 3 and rows(seen) == [("positive", "warn", 3, 1)]
    kept, _ = Q.check(df, [Q.Expectation("positive", "v > 0", "drop")])
    assert sorted(rows(kept), key=str) == [(1,), (None,)]
    kept, seen = Q.check(df, [Q.Expectation("positive", "v > 0", "drop", null_passes=False)])
    assert rows(kept) == [(1,)] and seen.first()["violations"] == 2
    assert Q.add_expectation([warn], Q.Expectation("positive", "v > 5")) == (warn,)


def test_anomaly_texts(spark):
    orgs = spark.createDataFrame([org(1, total=9, size="Large"), org(2, total=16, nat=8, size="Micro")], ORG)
    people = spark.createDataFrame([person(1, salary=1400), person(2, salary=1999), person(3, salary=100001), person(4, salary=2000)], PERSON)
    got = sorted(rows(Q.anomalies(orgs, people), "record_id", "column_name", "anomaly_description", "severity"))
    assert got == [
        ("1", "salary", "Salary unusually low for t", "High"),
        ("1", "total", "Organisation has very few employees for size category: Large", "Low"),
        ("2", "salary", "Salary unusually low for t", "Medium"),
        ("2", "total", "Organisation has unusually many employees for size category: Micro", "Low"),
        ("3", "salary", "Salary unusually high for t", "Medium"),
    ]


def test_rate_mismatch_value(spark):
    bad = list(org(1, total=3, nat=1))
    bad[9] = 0.5
    got = Q.detect(spark.createDataFrame([tuple(bad)], ORG), Q.rate_anomaly()).first()
    assert got["value"] == "0.5 vs calculated: 0.3333"


def test_catalogue_table(spark):
    got = Q.rules_catalog(spark, CHECKS, dt.datetime(2020, 1, 1), {Q.ORGS: "raw.orgs"})
    assert {r[0] for r in rows(got, "target_table")} == {"raw.orgs", Q.PEOPLE}
    assert got.count() == len(CHECKS) and {"created_date", "last_updated"} <= set(got.columns)


def test_dashboard_grades(spark):
    schema = "table_name string, weighted_dq_score double, total_records_checked bigint, total_records_failed bigint"
    none = spark.createDataFrame([], "x int")
    for score, grade in ((95.0, "Excellent"), (94.99, "Good"), (70.0, "Fair"), (69.99, "Poor")):
        got = {r["metric_name"]: r for r in Q.dashboard(spark.createDataFrame([("t", score, 5, 0)], schema), none).collect()}
        assert got["Overall Data Quality Score"]["status"] == grade
        assert got["Failed Records"]["status"] == "Good" and got["Anomalies Detected"]["metric_value"] == 0.0
