"""Gates, stored distinct counts and score curves."""

import duckdb
import pytest
from conftest import rows
from pyspark.sql import functions as F

from musterline.operators import curves, distinct
from musterline.operators.gate import BROKEN, Gate, Gated
from musterline.operators.quality import Expectation, violations
from musterline.streaming import jobs

RULES = [
    Expectation("positive", "n > 0", "drop"),
    Expectation("named", "name IS NOT NULL"),
    Expectation("known", "n < 100", "drop", null_passes=False),
]
SCHEMA = "id bigint, n int, name string"
PEOPLE = [(1, 5, "a"), (2, -1, None), (3, None, "c"), (4, 200, "d"), (5, 7, None)]


def gated(spark, path):
    return Gated(spark, str(path), SCHEMA)


def test_one_write_gives_kept_rejected_and_counts(spark, tmp_path):
    people = spark.createDataFrame(PEOPLE, SCHEMA)
    counts = Gate(RULES).write(people, str(tmp_path))
    out = gated(spark, tmp_path)
    assert sorted(rows(out.kept(), "id", BROKEN)) == [(1, []), (5, ["named"])]
    assert sorted(rows(out.rejected(), "id", BROKEN)) == [(2, ["positive", "named"]), (3, ["known"]), (4, ["known"])]
    assert sorted(rows(counts)) == sorted(rows(violations(people, RULES))) == sorted(rows(out.counts().select(*counts.columns)))


def test_rows_are_scanned_once(spark, tmp_path):
    spark.createDataFrame(PEOPLE, SCHEMA).write.parquet(str(tmp_path / "in"))
    marked = Gate(RULES).marked(spark.read.parquet(str(tmp_path / "in")))
    assert marked._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    scans = spark.sparkContext.accumulator(0)
    seen = spark.read.schema(SCHEMA).parquet(str(tmp_path / "in")).mapInArrow(lambda it: (scans.add(b.num_rows) or b for b in it), SCHEMA)
    Gate(RULES).write(seen, str(tmp_path / "out"))
    assert scans.value == len(PEOPLE)


def test_stream_and_batch_counts_agree_and_a_replay_counts_once(spark, tmp_path):
    gate, landing = Gate(RULES), str(tmp_path / "in")
    stream = lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(landing)
    spark.createDataFrame(PEOPLE, SCHEMA).repartition(3).write.parquet(landing)
    handle = lambda batch, i: gate.write(batch, str(tmp_path / "out"), i) and None
    jobs.start_batches(stream(), handle, str(tmp_path / "c")).awaitTermination()
    want = sorted(rows(violations(spark.read.parquet(landing), RULES)))
    columns = ["expectation", "policy", "rows_checked", "violations"]
    assert sorted(rows(gated(spark, tmp_path / "out").counts(), *columns)) == want
    (tmp_path / "c" / "commits" / "2").unlink()
    (tmp_path / "c" / "commits" / ".2.crc").unlink(missing_ok=True)
    jobs.start_batches(stream(), handle, str(tmp_path / "c")).awaitTermination()
    assert sorted(rows(gated(spark, tmp_path / "out").counts(), *columns)) == want
    assert gated(spark, tmp_path / "out").kept().count() == 2


def test_gate_of_nothing(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    assert sorted(rows(Gate(RULES).write(none, str(tmp_path / "a"))))[0][2:] == (0, 0)
    assert gated(spark, tmp_path / "a").rejected().count() == 0
    Gate([]).write(spark.createDataFrame(PEOPLE, SCHEMA), str(tmp_path / "b"))
    assert gated(spark, tmp_path / "b").kept().count() == 5


def test_bitmaps_of_batches_unite_to_the_distinct_count(spark):
    data = [(i % 3, "A" if i % 5 else "B", (i * 7919) % 90_000) for i in range(5000)] + [(0, "A", None), (1, "C", None), (2, "A", 0)]
    df = spark.createDataFrame(data, "batch int, symbol string, id bigint")
    stored = distinct.bitmaps(df, ["batch", "symbol"], {"ids": "id", "tens": F.expr("id div 10")})
    got = {r.symbol: (r.ids, r.tens) for r in distinct.united(stored, ["symbol"], ["ids", "tens"]).collect()}
    for s in "AB":
        ids = {i for _, x, i in data if x == s and i is not None}
        assert got[s] == (len(ids), len({i // 10 for i in ids}))
    assert "C" not in got
    part = {(r.batch, r.symbol): r.ids for r in distinct.united(stored, ["batch", "symbol"], ["ids"]).collect()}
    assert part[(2, "A")] == len({i for b, x, i in data if (b, x) == (2, "A") and i is not None})


@pytest.mark.parametrize("n", [400, 1])
def test_curves_equal_sql_over_the_scores(spark, tmp_path, n):
    scores = [(i, ((i * 37) % 101) / 100, 1 if (i * 37) % 101 + i % 40 > 80 else 0) for i in range(n)]
    spark.createDataFrame(scores, "id int, score double, y int").write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    cells = curves.score_cells(stored, "score", "y", cells=100)
    sql = f"""WITH c AS (SELECT least(floor(score * 100), 100) AS cell, count(*) AS n, sum(y) AS p FROM '{tmp_path}/s/*.parquet' GROUP BY 1)
      SELECT cell / 100, sum(n) OVER w, sum(p) OVER w FROM c WINDOW w AS (ORDER BY cell DESC)"""
    want = sorted((round(a, 6), int(b), int(c)) for a, b, c in duckdb.sql(sql).fetchall())
    assert sorted((round(a, 6), b, c) for a, b, c in rows(curves.cutoffs(cells, count=100), "cutoff", "called", "hits")) == want
    row = curves.areas(cells).first()
    cell = lambda s: int(s * 100)
    p, q = [cell(s) for _, s, y in scores if y], [cell(s) for _, s, y in scores if not y]
    if p and q:
        pairs = sum((a > b) + (a == b) / 2 for a in p for b in q) / len(p) / len(q)
        assert row.roc_area == pytest.approx(pairs, abs=1e-6) and 0 < row.average_precision <= 1
    else:
        assert row.roc_area is None
    assert curves.calibration(cells, 10, 100).agg(F.sum("rows")).first()[0] == n


def test_curves_of_nothing(spark):
    none = spark.createDataFrame([(None, 1), (0.5, None)], "score double, y int")
    cells = curves.score_cells(none, "score", "y")
    assert curves.cutoffs(cells).count() == 0 and rows(curves.areas(cells)) == [(0, 0, None, None)]
