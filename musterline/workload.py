"""Registered queries: every operator over the bound test tables."""

from __future__ import annotations

import datetime as dt
import zlib
from collections.abc import Callable
from dataclasses import replace
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import workload_files, workload_more, workload_streams
from .operators import features, gold, lookups, market, models, planning, quality, reports, silver, trades
from .plans import layers, sql_functions
from .plans.bindings import AS_OF, POLICY, Bindings
from .session import discard, scratch
from .sinks import tables
from .sources import files, wire
from .streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]

SCENARIOS = (
    {"scenario": "grow", "nat_hires": 5},
    {"scenario": "swap", "nat_hires": 3, "other_leaves": 3},
    {"scenario": "shrink", "nat_leaves": 4, "other_leaves": 1},
    {"scenario": "idle"},
)


def _org(b: Bindings) -> DataFrame:
    return silver.org_clean(b.orgs(), AS_OF, POLICY)


def _person(b: Bindings) -> DataFrame:
    return silver.person_clean(b.people(), AS_OF, POLICY)


def _gap(b: Bindings) -> DataFrame:
    return silver.org_gap(_org(b), b.rules(), POLICY)


def _summary(b: Bindings) -> DataFrame:
    return silver.org_people_summary(_org(b), _person(b))


def _risk(b: Bindings) -> DataFrame:
    return gold.risk_score(_gap(b), gold.risk_counts_from_people(_person(b)), b.alerts(), POLICY)


def _hires(b: Bindings, target: str | None = None) -> DataFrame:
    return planning.hires_to_target(_org(b), b.rules(), target, POLICY)


def _plan_documents(b: Bindings) -> DataFrame:
    """Nested plans, shown by their size and last month."""
    last = F.element_at("monthly_plan", -1)
    return planning.plan_documents(_hires(b, POLICY.default_target)).select(
        "org_id",
        "target_tier",
        "total_hires",
        "annual_cost",
        F.size("monthly_plan").cast("bigint").alias("months"),
        last["hires_this_month"].alias("last_hires"),
        last["projected_rate_pct"].alias("final_rate_pct"),
        last["cumulative_payroll"].alias("final_payroll"),
    )


NOW = dt.datetime(2000, 1, 1)


def _checks() -> list[quality.Check]:
    return quality.checks(quality.declaration(AS_OF, POLICY))


def _dq_results(b: Bindings) -> DataFrame:
    tables = {quality.ORGS: b.reported_orgs(), quality.PEOPLE: b.reported_people()}
    return quality.validate(tables, _checks(), NOW)


def _dq_anomalies(b: Bindings) -> DataFrame:
    return quality.anomalies(b.reported_orgs(), b.people())


def _dq_summary(b: Bindings) -> DataFrame:
    return quality.summary(_dq_results(b))


def _dq_dashboard(b: Bindings) -> DataFrame:
    return _ntz(quality.dashboard(_dq_summary(b), _dq_anomalies(b), as_of=NOW), "as_of")


def _dq_warn(b: Bindings) -> DataFrame:
    orgs = quality.violations(b.reported_orgs(), quality.expectations(_checks(), quality.ORGS))
    return orgs.unionByName(quality.violations(b.reported_people(), quality.expectations(_checks(), quality.PEOPLE)))


def _dq_drop(b: Bindings) -> DataFrame:
    rules = [
        replace(r, policy="drop")
        for r in quality.expectations(_checks(), quality.PEOPLE)
        if r.name.endswith((".salary.within", ".hire_date.within"))
    ]
    return quality.check(b.people(), rules)[0]


def _call(sql: str) -> Callable[[Bindings], DataFrame]:
    """Query over the registered SQL functions, which read the bound tables through views."""

    def run(b: Bindings) -> DataFrame:
        views = {"orgs": b.orgs, "people": b.people, "rules": b.rules, "alerts": b.alerts}
        names = {k: f"bound_{k}" for k in views}
        for k, build in views.items():
            build().createOrReplaceTempView(names[k])
        sql_functions.register(b.spark, names, AS_OF, POLICY)
        return b.spark.sql(sql)

    return run


def _trades(b: Bindings) -> DataFrame:
    return trades.with_times(b.trades())


def _ntz(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps without zone, as the SQL check has them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _daily(b: Bindings) -> DataFrame:
    """Trades with the day as their batch."""
    day = F.datediff(F.col("trade_timestamp"), F.lit(dt.date(2024, 1, 1)))
    return _trades(b).withColumn("batch_id", day.cast("bigint"))


def _daily_alerts(b: Bindings) -> DataFrame:
    return trades.trade_alerts(_daily(b), ["batch_id", "symbol"])


LANDED_COLUMNS = [*wire.WIRE_FIELDS, "trade_value"]


def _landing(b: Bindings, frame: DataFrame, label: str) -> tuple[str, str]:
    """NDJSON files in a new shared folder, and a folder for the stream's output."""
    base = scratch(b.spark, label)
    tables.write_ndjson(frame, f"{base}/landing", max_rows=100_000)
    return f"{base}/landing", base


def _stream_raw(b: Bindings) -> DataFrame:
    landing, base = _landing(b, b.trades(), "raw")
    stream = files.trade_stream(b.spark, landing)
    jobs.ingest_trades(stream, f"{base}/trades_raw", f"{base}/ckpt", name=None).awaitTermination()
    discard(b.spark, landing)
    raw = b.spark.read.schema(files.RAW).parquet(f"{base}/trades_raw")
    return _ntz(raw.select(*LANDED_COLUMNS, "trade_timestamp"), "trade_timestamp")


def _chained_table(name: str, schema: str, *drop: str) -> Callable[[Bindings], DataFrame]:
    def run(b: Bindings) -> DataFrame:
        landing, base = _landing(b, b.trades(), name)
        jobs.chain(b.spark, landing, f"{base}/out", f"{base}/ckpt")
        discard(b.spark, landing, f"{base}/out/trades_raw")
        return b.spark.read.schema(schema).parquet(f"{base}/out/{name}").drop(*drop)

    return run


def _stream_batches(b: Bindings) -> DataFrame:
    """Six files taken two at a time: every batch is a partition of its own, and nothing is lost or doubled."""
    base = scratch(b.spark, "batches")
    tables.write_ndjson(b.trades().repartition(6, "trade_id"), f"{base}/landing", max_rows=1_000_000)
    stream = files.trade_stream(b.spark, f"{base}/landing", max_files=2)
    jobs.ingest_batches(stream, f"{base}/trades", f"{base}/ckpt", name=None).awaitTermination()
    discard(b.spark, f"{base}/landing", f"{base}/ckpt")
    stored = b.spark.read.parquet(f"{base}/trades")
    return stored.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("trades"),
        F.sum("trade_id").alias("id_sum"),
        (F.count_distinct("batch_id") > 1).alias("several_batches"),
    )


def _stream_windowed(b: Bindings) -> DataFrame:
    landing, base = _landing(b, b.trades(), "windowed")
    result = jobs.windowed_metrics(files.trade_stream(b.spark, landing), "1 hour", "10 minutes")
    jobs.write_files(result, f"{base}/windows", f"{base}/ckpt").awaitTermination()
    discard(b.spark, landing)
    return _ntz(b.spark.read.schema(result.schema).parquet(f"{base}/windows"), "window_start", "window_end")


def _stream_dedup(b: Bindings) -> DataFrame:
    """Every third trade is landed twice more."""
    copies = b.trades().filter("trade_id % 3 = 0")
    landing, base = _landing(b, b.trades().unionByName(copies).unionByName(copies), "dedup")
    result = jobs.dedup_trades(files.trade_stream(b.spark, landing), watermark="1 day", spread=8)
    jobs.write_files(result, f"{base}/unique", f"{base}/ckpt").awaitTermination()
    discard(b.spark, landing)
    return b.spark.read.schema(result.schema).parquet(f"{base}/unique").select(*LANDED_COLUMNS)


def _stream_normalise(b: Bindings) -> DataFrame:
    base = scratch(b.spark, "wire")
    b.wire_messages().write.text(f"{base}/messages")
    result = wire.normalise_trades(files.message_stream(b.spark, f"{base}/messages"))
    jobs.write_files(result, f"{base}/trades", f"{base}/ckpt").awaitTermination()
    discard(b.spark, f"{base}/messages")
    return b.spark.read.schema(result.schema).parquet(f"{base}/trades")


def _ndjson_roundtrip(b: Bindings) -> DataFrame:
    path = f"{scratch(b.spark, 'ndjson')}/trades"
    tables.write_ndjson(b.trades(), path)
    return files.read_ndjson(b.spark, path, files.LANDED)


#: Narrower than what the values would be read as.
CSV_HINTS = "total int, nationals int, non_nationals int, last_updated timestamp_ntz"


def _csv_roundtrip(b: Bindings) -> DataFrame:
    """Organisations written as CSV and loaded twice with types found in them; the second load finds nothing new."""
    base = scratch(b.spark, "csv")
    orgs = b.orgs()
    orgs.write.option("header", True).csv(f"{base}/csv")
    for _ in range(2):
        loaded = files.load_csv(b.spark, f"{base}/csv", None, f"{base}/table", f"{base}/ledger", hints=CSV_HINTS)
    discard(b.spark, f"{base}/csv")
    return loaded.drop("_ingestion_timestamp", "_source_file")


def _layer_counts(b: Bindings) -> DataFrame:
    views = {"orgs": _org, "people": _person, "gap": _gap, "alerts": Bindings.alerts}
    for name, build in views.items():
        build(b).createOrReplaceTempView(f"layer_{name}")
    return tables.layer_counts(b.spark, [f"layer_{n}" for n in views] + ["layer_missing"]).drop("error")


def _features(b: Bindings) -> DataFrame:
    return features.org_features(b.orgs(), b.people(), b.alerts(), POLICY)


def _encoded(b: Bindings) -> DataFrame:
    columns = ["sector", "size", "region", "tier"]
    return features.encode(b.orgs(), columns).select("org_id", *[f"{c}_encoded" for c in columns])


def _risk_model(b: Bindings) -> DataFrame:
    table = _stored(b, _features(b), "features")
    return models.risk_probabilities(models.fit_risk_model(table), table)


def _trade_rejects(b: Bindings) -> DataFrame:
    return wire.rejected(b.faulty_messages()).groupBy("reason").agg(F.count(F.lit(1)).alias("messages"))


def _database(b: Bindings, label: str) -> str:
    """A database for one folder of test tables, in the shared folder; it is filled anew whenever a query needs it."""
    name = f"{label}_{zlib.crc32(b.folder.encode()):08x}"
    tables.ensure_db(b.spark, name, location=scratch(b.spark, name))
    return name


def _raw_tables(b: Bindings, db: str) -> None:
    """The declared raw tables, whose ids are text, filled from the bindings; the audit columns fill themselves."""
    for name, *_ in tables.RAW_TABLES:
        b.spark.sql(f"DROP TABLE IF EXISTS {db}.{name}")
    tables.create_raw_tables(b.spark, db)
    rows = {
        "organisations": b.orgs(), "people": b.people(), "tier_rules": b.rules(),
        "sector_benchmarks": b.benchmarks(), "alerts": b.alerts(),
    }
    for name, frame in rows.items():
        declared = {f.name: f.dataType for f in b.spark.table(f"{db}.{name}").schema.fields}
        tables.append_rows(frame.select(*[F.col(c).cast(declared[c]).alias(c) for c in frame.columns]), f"{db}.{name}")


def _tvf_on_raw_tables(b: Bindings) -> DataFrame:
    """Table functions over declared tables with text ids."""
    db = _database(b, "raw_tools")
    _raw_tables(b, db)
    names = {"orgs": "organisations", "people": "people", "rules": "tier_rules", "alerts": "alerts"}
    sql_functions.register(b.spark, {k: f"{db}.{v}" for k, v in names.items()}, AS_OF, POLICY)
    return b.spark.sql(
        "SELECT 'org' AS kind, org_id AS id, name AS label FROM org_status('#00000001') UNION ALL "
        "SELECT 'person', person_id, job_title FROM org_people('#000000010') UNION ALL "
        "SELECT 'expiring', person_id, department FROM expiring_nationals('customer#', 60)"
    )


def _layers(b: Bindings) -> layers.Layers:
    """All layers built from the declared raw tables."""
    at = layers.Layers(*[_database(b, f"layers_{n}") for n in ("bronze", "silver", "gold", "quality")])
    _raw_tables(b, at.bronze)
    layers.build_all(b.spark, AS_OF, POLICY, NOW, at)
    return at


def _layer_at_risk(b: Bindings) -> DataFrame:
    found = b.spark.table(f"{_layers(b).gold}.at_risk_orgs")
    return found.withColumn("org_id", F.col("org_id").cast("bigint"))


def _layer_departments(b: Bindings) -> DataFrame:
    found = b.spark.table(f"{_layers(b).gold}.department_share")
    return found.withColumn("org_id", F.col("org_id").cast("bigint"))


def _layer_audit(b: Bindings) -> DataFrame:
    """Rows of raw tables by the file their default names, and of stored ones by the time they were given."""
    at = _layers(b)
    raw = [
        b.spark.table(f"{at.bronze}.{n}").groupBy(F.lit(n).alias("name"), F.col("_source_file").alias("mark"))
        for n in ("organisations", "people", "alerts")
    ]
    kept = b.spark.table(f"{at.silver}.people").groupBy(
        F.lit("silver people").alias("name"), F.date_format("processed_at", "yyyy-MM-dd").alias("mark")
    )
    return reduce(DataFrame.unionByName, [g.agg(F.count(F.lit(1)).alias("rows")) for g in [*raw, kept]])


#: Arguments of one call per stored function.
CALLS = {
    "org_status": "'#00000001'", "orgs_in_tier": "'high green'", "sector_summary": "'U'", "expiring_nationals": "'customer#', 60",
    "org_alerts": "'#00000001'", "overall_summary": "", "tier_thresholds": "'BUILDING', 'Small'", "hires_needed": "'#000000010', 'High Green'",
    "simulate_change": "'#000000010', 5, 0, 0, 3", "org_people": "'customer#0000001'", "list_orgs": "",
}


def _functions_listed(b: Bindings) -> DataFrame:
    """The functions a database lists, each with the rows that a call gives over the stored tables."""
    db = _database(b, "tools")
    raw = _database(b, "raw_tools")
    _raw_tables(b, raw)
    names = {"orgs": "organisations", "people": "people", "rules": "tier_rules", "alerts": "alerts"}
    sql_functions.register(b.spark, {k: f"{raw}.{v}" for k, v in names.items()}, AS_OF, POLICY, db=db)
    listed = sql_functions.list_functions(b.spark, db)
    # The session's own functions are listed too, without a database.
    stored = [name.split(".")[-1] for (name,) in listed.collect() if f"{db}." in name]
    before = b.spark.catalog.currentDatabase()
    b.spark.catalog.setCurrentDatabase(db)
    try:
        calls = [f"SELECT '{name}' AS function, count(*) AS rows FROM {name}({CALLS[name]})" for name in stored]
        return b.spark.sql(" UNION ALL ".join(calls))
    finally:
        b.spark.catalog.setCurrentDatabase(before)


def _ndjson_malformed(b: Bindings) -> DataFrame:
    """Lines that do not parse are kept apart; every 40th is cut short."""
    path = f"{scratch(b.spark, 'broken')}/lines"
    line = F.to_json(F.struct(*[F.col(c) for c in LANDED_COLUMNS]))
    cut = F.when(F.col("trade_id") % 40 == 0, F.substring(line, 1, 30)).otherwise(line)
    b.trades().select(cut.alias("value")).write.text(path)
    read = files.read_ndjson(b.spark, path, files.LANDED, corrupt_col="broken")
    counts = F.count(F.lit(1)).alias("lines"), F.count("trade_id").alias("trades")
    return read.groupBy(F.col("broken").isNotNull().alias("is_broken")).agg(*counts)


def _segments(b: Bindings) -> models.Segments:
    return models.segment(_stored(b, _features(b), "features"))


def _tier_model(b: Bindings) -> models.Fitted:
    return models.fit_tier_model(_stored(b, _features(b), "features"))


def _tier_test_rows(b: Bindings) -> DataFrame:
    """Test rows per actual tier, out of the confusion table."""
    fitted = _tier_model(b)
    names = fitted.tested.select("tier", F.col("label").cast("double").alias("actual")).distinct()
    table = models.confusion(fitted).groupBy("actual").agg(F.sum("rows").alias("orgs"))
    return table.join(names, "actual").select("tier", "orgs")


def _stored(b: Bindings, frame: DataFrame, label: str) -> DataFrame:
    """The frame from a table in the shared folder, for jobs that read it many times."""
    path = scratch(b.spark, label)
    frame.write.parquet(path)
    return b.spark.read.parquet(path)


BATCH: dict[str, Callable[[Bindings], DataFrame]] = {
    "org_clean": _org,
    "person_clean": _person,
    "org_people_summary": _summary,
    "org_gap": _gap,
    "attrition_risk": lambda b: silver.attrition_risk(_person(b), _org(b), POLICY),
    "kpi_tier": lambda b: gold.kpi_tier(_gap(b), POLICY),
    "kpi_sector": lambda b: gold.kpi_sector(_summary(b), b.benchmarks(), POLICY),
    "kpi_region": lambda b: gold.kpi_region(_summary(b), POLICY),
    "risk_score": _risk,
    "at_risk_orgs": lambda b: gold.at_risk(_risk(b)),
    "exec_dashboard": lambda b: gold.exec_dashboard(_risk(b), AS_OF, POLICY),
    "department_share": lambda b: gold.department_share(_person(b), _org(b)),
    "hires_to_target": _hires,
    "hiring_plan": lambda b: planning.hiring_plan(_hires(b, POLICY.default_target)),
    "hiring_plan_documents": _plan_documents,
    "what_if": lambda b: planning.what_if(_org(b), b.rules(), SCENARIOS, POLICY),
    "top_hires": lambda b: planning.top_hires(_hires(b, POLICY.default_target)),
    "hires_by_tier": lambda b: planning.hires_by_tier(_hires(b, POLICY.default_target)),
    "dq_validation": lambda b: _ntz(_dq_results(b), "check_timestamp"),
    "dq_summary": _dq_summary,
    "dq_anomalies": _dq_anomalies,
    "dq_dashboard": _dq_dashboard,
    "dq_by_type": lambda b: quality.by_check_type(_dq_results(b)),
    "dq_failed_rules": lambda b: _ntz(quality.failed_rules(_dq_results(b)), "check_timestamp"),
    "dq_expect_warn": _dq_warn,
    "dq_expect_drop": _dq_drop,
    "dq_orphans": lambda b: quality.orphans(b.reported_people(), b.orgs(), "org_id"),
    "tvf_org_status": _call("SELECT * FROM org_status('CUSTOMER#00000001')"),
    "tvf_orgs_in_tier": _call("SELECT * FROM orgs_in_tier('high green')"),
    "tvf_sector_summary": _call("SELECT * FROM sector_summary('U')"),
    "tvf_sector_profile": lambda b: lookups.sector_profile(b.orgs(), b.benchmarks(), "BUILDING", POLICY),
    "tvf_expiring_nationals": _call("SELECT * FROM expiring_nationals('customer#', 60)"),
    "tvf_org_alerts": _call("SELECT * FROM org_alerts('#00000001')"),
    "tvf_alerts_filtered": lambda b: lookups.org_alerts(b.alerts(), "#0000000", "High", True, POLICY),
    "tvf_overall_summary": _call("SELECT * FROM overall_summary()"),
    # One call per row of the left side.
    "tvf_tier_thresholds": _call(
        "SELECT t.*, s.orgs FROM (SELECT sector, size, count(*) AS orgs FROM bound_orgs GROUP BY sector, size) s, "
        "LATERAL tier_thresholds(s.sector, s.size) t"
    ),
    "tvf_hires_needed": _call("SELECT * FROM hires_needed('#000000010', 'High Green')"),
    "tvf_simulate_change": _call("SELECT * FROM simulate_change('#000000010', 5, 0, 0, 3)"),
    "tvf_org_people": _call("SELECT * FROM org_people('customer#0000001')"),
    "tvf_people_filtered": lambda b: lookups.org_people(b.people(), b.orgs(), "#", True, 30, AS_OF, POLICY),
    "tvf_list_orgs": _call("SELECT * FROM list_orgs()"),
    "tvf_compare": lambda b: lookups.compare(b.orgs(), ["#000000007", "#00000001", "#000000042", "nobody"], POLICY),
    "trade_normalise": lambda b: wire.normalise_trades(b.wire_messages()),
    "trade_metrics": lambda b: trades.trade_metrics(b.trades()),
    "trade_alerts": lambda b: _ntz(trades.trade_alerts(b.trades()), "alert_time"),
    "market_summary": lambda b: market.market_summary(b.trades()),
    "market_lite": lambda b: market.market_lite(b.trades()),
    "session_rollup": lambda b: market.session_rollup(trades.trade_metrics(_daily(b), ["batch_id", "symbol"])),
    "volume_per_minute": lambda b: _ntz(market.volume_over_time(_trades(b), "minute"), "minute"),
    "volume_per_second": lambda b: _ntz(market.volume_over_time(_trades(b), "second"), "second"),
    "live_activity": lambda b: _ntz(
        market.live_activity(_trades(b), 1440, F.lit("2024-01-30 12:00:00").cast("timestamp")), "second"
    ),
    "pressure": lambda b: market.pressure(b.trades()),
    "recent_trades": lambda b: _ntz(market.recent_trades(_trades(b)), "trade_timestamp"),
    "recent_alerts": lambda b: _ntz(market.recent_alerts(_daily_alerts(b)), "alert_time"),
    "latest_trade": lambda b: market.latest_per_key(
        b.trades(), ["symbol"], F.desc("trade_time"), F.desc("trade_id")
    ).select("symbol", "trade_id", "price", "quantity"),
    "stream_raw": _stream_raw,
    "stream_metrics": _chained_table("trades_analytics", tables.METRICS, "window_start", "window_end", "batch_id"),
    "stream_alerts": _chained_table("price_alerts", tables.ALERTS, "alert_time", "batch_id"),
    "stream_batches": _stream_batches,
    "stream_windowed": _stream_windowed,
    "stream_dedup": _stream_dedup,
    "stream_normalise": _stream_normalise,
    "ndjson_roundtrip": _ndjson_roundtrip,
    "csv_roundtrip": _csv_roundtrip,
    "layer_counts": _layer_counts,
    "value_counts": lambda b: reports.value_counts(b.orgs(), "tier"),
    "histogram": lambda b: reports.histogram(b.orgs().select((F.col("rate") * 100).alias("rate")), "rate", 20),
    "crosstab": lambda b: reports.crosstab(b.orgs(), "sector", "size", POLICY.sizes),
    "salary_by_sector": lambda b: reports.salary_by_sector(b.people(), b.orgs()),
    "salary_by_department": lambda b: reports.describe_by(b.people(), "department", "salary"),
    "sector_rate": lambda b: reports.mean_by(b.orgs(), "sector", "rate", times=100),
    "org_features": _features,
    "encoded": _encoded,
    "class_weights": lambda b: features.class_weights(b.orgs(), "tier"),
    "describe_fractional": lambda b: reports.describe_by(
        b.orgs().select("sector", (F.col("rate") * 100).alias("rate")), "sector", "rate", 2
    ).select("sector", "mean", "std"),
    "trade_rejects": _trade_rejects,
    "tvf_on_raw_tables": _tvf_on_raw_tables,
    "layers_at_risk": _layer_at_risk,
    "layers_departments": _layer_departments,
    "layers_audit": _layer_audit,
    "functions_listed": _functions_listed,
    "ndjson_malformed": _ndjson_malformed,
    "hash_split": lambda b: features.split(b.orgs(), "org_id").groupBy("is_test").count(),
    "stratified_split": lambda b: features.stratified_split(b.orgs(), "org_id", "tier")
    .groupBy("tier", "is_test")
    .agg(F.count(F.lit(1)).alias("orgs")),
}

# Iterative: fitted when called.
MODELS: dict[str, Callable[[Bindings], DataFrame]] = {
    "tier_model": lambda b: models.classification_report(models.fit_tier_model(_stored(b, _features(b), "features"))),
    "rate_model": lambda b: models.regression_report(
        models.fit_rate_model(_stored(b, _features(b), "features")), "rate"
    ),
    "risk_model": _risk_model,
    "salary_model": lambda b: models.regression_report(models.fit_salary_model(b.people(), b.orgs()), "salary"),
    "segments": lambda b: models.segment_profiles(models.segment(_stored(b, _features(b), "features")).rows),
    "tier_test_rows": _tier_test_rows,
    "tier_confusion": lambda b: models.confusion(_tier_model(b)),
    "tier_importances": lambda b: _tier_model(b).importances(),
    "risk_by_sector": lambda b: models.risk_by_sector(_risk_model(b)),
    "elbow": lambda b: models.elbow_costs(b.spark, _segments(b)),
    "clusters_by_size": lambda b: models.cluster_table(_segments(b).rows, "size"),
    "clusters_by_sector": lambda b: models.cluster_table(_segments(b).rows, "sector"),
    "pca_2d": lambda b: models.project2d(models.standardise(_features(b))).select("org_id", "pc1", "pc2"),
}


def _bound(build: Callable[[Bindings], DataFrame], spark: SparkSession, folder: str) -> DataFrame:
    return build(Bindings(spark, folder))


def all_queries() -> dict[str, Query]:
    return {name: partial(_bound, build) for name, build in {**BATCH, **MODELS, **workload_files.QUERIES, **workload_streams.QUERIES, **workload_more.QUERIES}.items()}
