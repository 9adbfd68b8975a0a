import datetime as dt

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from musterline.operators import gold, quality, silver
from musterline.plans import layers
from musterline.plans.bindings import AS_OF, POLICY
from musterline.session import discard, scratch, shared_dir
from musterline.sinks import tables
from musterline.sources import files


def test_csv_files_are_loaded_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    load = lambda: files.load_csv(spark, str(tmp_path / "in"), "a int, b string", str(tmp_path / "t"), str(tmp_path / "l"))
    (tmp_path / "in" / "one.csv").write_text("a,b\n1,x\n2,y\n")
    assert load().count() == 2
    assert load().count() == 2
    (tmp_path / "in" / "two.csv").write_text("a,b\n3,z\n")
    got = load()
    assert sorted(rows(got, "a", "_source_file")) == [(1, "one.csv"), (2, "one.csv"), (3, "two.csv")]
    assert got.filter("_ingestion_timestamp is null").count() == 0
    inferred = files.read_csv(spark, str(tmp_path / "in"))
    assert dict(inferred.dtypes) == {"a": "int", "b": "string"}


def test_ndjson_files_are_capped(spark, tmp_path):
    path = str(tmp_path / "n")
    tables.write_ndjson(spark.range(25).coalesce(1), path, max_rows=10)
    assert len(list((tmp_path / "n").glob("*.json"))) == 3
    assert files.read_ndjson(spark, path).count() == 25


def test_declared_tables_fill_their_defaults(spark):
    tables.create_raw_tables(spark, "raw_test")
    tables.create_raw_tables(spark, "raw_test")
    df = spark.createDataFrame([("B1", "S")], "benchmark_id string, sector string")
    tables.append_rows(df, "raw_test.sector_benchmarks")
    got = spark.table("raw_test.sector_benchmarks").first()
    assert got["_source_file"] == "sector_benchmarks.csv" and got["_ingestion_timestamp"] is not None
    tables.create_stream_tables(spark, "raw_test", suffix="_live", replace=True)
    tables.create_stream_tables(spark, "raw_test", suffix="_live", replace=True)
    assert spark.table("raw_test.price_alerts_live").count() == 0
    assert spark.table("raw_test.trades_raw_live").columns[-1] == "batch_id"


def test_overwrite_replaces_the_schema_and_views_follow(spark):
    tables.ensure_db(spark, "w_test")
    tables.write_table(spark.range(3), "w_test.t")
    tables.write_table(spark.range(2).withColumn("x", F.lit("a")), "w_test.t")
    assert spark.table("w_test.t").columns == ["id", "x"]
    tables.create_view(spark, "w_test.v", "SELECT id FROM w_test.t WHERE id > 0")
    tables.create_view(spark, "w_test.v", "SELECT id FROM w_test.t")
    counts = tables.layer_counts(spark, ["w_test.t", "w_test.v", "w_test.none"])
    assert rows(counts, "name", "rows") == [("w_test.t", 2), ("w_test.v", 2), ("w_test.none", None)]
    assert counts.filter("error = 'TABLE_OR_VIEW_NOT_FOUND'").count() == 1
    with pytest.raises(AnalysisException):
        tables.write_table(spark.table("w_test.t"), "w_test.t")


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch(spark, "x") != scratch(spark, "x")


def test_only_shared_folders_are_discarded(spark, tmp_path):
    mine = scratch(spark, "gone")
    spark.range(3).write.parquet(mine)
    discard(spark, mine, mine)
    with pytest.raises(AnalysisException):
        spark.read.parquet(mine)
    with pytest.raises(ValueError):
        discard(spark, str(tmp_path))


@pytest.fixture(scope="module")
def built(spark, bound):
    tables.ensure_db(spark, "b_raw")
    raw = {
        "organisations": bound.orgs(),
        "people": bound.people(),
        "tier_rules": bound.rules(),
        "sector_benchmarks": bound.benchmarks(),
        "alerts": bound.alerts(),
    }
    for name, df in raw.items():
        tables.write_table(df, f"b_raw.{name}")
    at = layers.Layers("b_raw", "b_silver", "b_gold", "b_dq")
    return layers.build_all(spark, AS_OF, POLICY, dt.datetime(2024, 1, 1), at)


def test_layers_hold_what_the_operators_give(spark, bound, built):
    org = silver.org_clean(bound.orgs(), AS_OF, POLICY)
    people = silver.person_clean(bound.people(), AS_OF, POLICY)
    gap = silver.org_gap(org, bound.rules(), POLICY)
    risk = gold.risk_score(gap, gold.risk_counts_from_people(people), bound.alerts(), POLICY)
    tables_dq = {quality.ORGS: bound.orgs(), quality.PEOPLE: bound.people()}
    names = {quality.ORGS: "b_raw.organisations", quality.PEOPLE: "b_raw.people"}
    checks = quality.checks(quality.declaration(AS_OF, POLICY))
    results = quality.validate(tables_dq, checks, dt.datetime(2024, 1, 1), names)
    want = {
        "b_silver.organisations": org,
        "b_silver.org_gap": gap,
        "b_gold.kpi_tier": gold.kpi_tier(gap, POLICY),
        "b_gold.risk_score": risk,
        "b_gold.at_risk_orgs": gold.at_risk(risk),
        "b_gold.exec_dashboard": gold.exec_dashboard(risk, AS_OF, POLICY),
        "b_dq.validation_results": results,
        "b_dq.failed_rules": quality.failed_rules(results),
    }
    for name, df in want.items():
        assert sorted(rows(spark.table(name), *df.columns), key=str) == sorted(rows(df), key=str), name
    share = gold.department_share(people, org)
    stored = spark.table("b_gold.department_share")
    assert sorted(map(str, rows(stored))) == sorted(map(str, rows(share)))
    metrics = quality.dashboard(quality.summary(results), quality.anomalies(bound.orgs(), bound.people()))
    view = spark.table("b_dq.dashboard")
    assert sorted(rows(view.drop("as_of"))) == sorted(rows(metrics))
    assert {r[0] for r in rows(view, "as_of")} == {dt.datetime(2024, 1, 1)}


def test_every_layer_is_counted(spark, built):
    counts = tables.layer_counts(spark, built)
    assert counts.count() == len(built) and counts.filter("rows is null or rows = 0").count() == 0


def test_audit_columns_are_stored(spark, built):
    assert spark.table("b_silver.people").first()["processed_at"] == dt.datetime(2024, 1, 1)
    assert "calculated_at" in spark.table("b_gold.risk_score").columns
