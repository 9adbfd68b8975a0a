"""Plans hold up when one key has a third of all rows."""

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_workforce import DAY, ORG, PERSON, org, person

from musterline.operators import features, gold, lookups, quality, silver
from musterline.plans.bindings import AS_OF, POLICY


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def static_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def skewed(spark, bound):
    """A third of all people, as a table, work for organisation 1."""
    people = bound.people().withColumn("org_id", F.when(F.col("person_id") % 3 == 0, 1).otherwise(F.col("org_id")))
    return silver.person_clean(people, AS_OF, POLICY), silver.org_clean(bound.orgs(), AS_OF, POLICY)


@pytest.fixture()
def conf(spark):
    kept = {}

    def put(key, value):
        kept[key] = spark.conf.get(key, None)
        spark.conf.set(key, value)

    yield put
    for key, value in kept.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_hot_organisation_is_split_in_the_row_join(spark, skewed, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1b")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.2")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1kb")
    people, orgs = skewed
    # Organisations that arrive partitioned by their id, and several map tasks, so that there is something to split.
    by_id = orgs.groupBy(*orgs.columns).count().drop("count").repartition("org_id")
    joined = silver.attrition_risk(people.repartition(8), by_id, POLICY)
    assert "skew=true" in final_plan(joined)
    assert joined.count() == people.count()


def test_people_meet_organisations_only_after_aggregation(skewed):
    people, orgs = skewed
    for df in (
        silver.org_people_summary(orgs, people),
        gold.department_share(people, orgs),
        gold.risk_counts_from_people(people),
    ):
        plan = static_plan(df)
        # Nothing but partial aggregations feeds the shuffles of people.
        assert "partial_count" in plan and "SortAggregate" not in plan
        assert "SortMergeJoin" not in plan or plan.index("SortMergeJoin") < plan.index("partial_count")


def test_hot_key_gives_the_same_result_however_it_is_split(spark, skewed, conf):
    people, orgs = skewed
    wide = sorted(rows(silver.org_people_summary(orgs, people.repartition(16))), key=str)
    conf("spark.sql.shuffle.partitions", "1")
    assert sorted(rows(silver.org_people_summary(orgs, people.coalesce(1))), key=str) == wide


def test_key_filters_and_lookups_reach_the_scan(spark, tmp_path, bound):
    path = str(tmp_path / "people")
    bound.people().write.parquet(path)
    people = spark.read.parquet(path)
    plan = static_plan(silver.person_clean(people, AS_OF, POLICY))
    assert "IsNotNull(person_id)" in plan and "IsNotNull(org_id)" in plan
    found = static_plan(lookups.org_people(people, bound.orgs(), "#000000001", policy=POLICY))
    assert "LeftSemi" in found and "IsNotNull(org_id)" in found


def test_one_scan_per_table_for_row_rules(spark, tmp_path, bound):
    path = str(tmp_path / "orgs")
    bound.orgs().write.parquet(path)
    rules = [r for r in quality.checks(quality.declaration(AS_OF, POLICY)) if r.table == quality.ORGS and r.by_row]
    plan = static_plan(quality.validate({quality.ORGS: spark.read.parquet(path)}, rules))
    assert len(rules) == 10 and plan.count("FileScan") == 1


def test_no_cross_join_in_any_batch_query(spark, bound):
    from musterline.workload import BATCH

    for name, build in BATCH.items():
        if name.startswith(("stream_", "csv_", "ndjson_")):
            continue
        plan = static_plan(build(bound))
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name


def test_split_ranks_slices_not_labels(bound):
    plan = static_plan(features.stratified_split(bound.orgs(), "org_id", "tier"))
    ranks = [line for line in plan.splitlines() if "row_number()" in line and "Window" in line]
    assert ranks and all("_slice" in line for line in ranks)


def test_empty_people_keep_every_organisation(spark):
    orgs = silver.org_clean(spark.createDataFrame([org(1)], ORG), DAY)
    none = silver.person_clean(spark.createDataFrame([person(None)], PERSON), DAY)
    assert rows(silver.org_people_summary(orgs, none), "org_id", "people") == [(1, None)]
