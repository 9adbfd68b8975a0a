"""Types found in files, versions of a schema, and input that does not fit."""

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from musterline.sources import files
from musterline.sources.rescue import parse_lines
from musterline.sources.schemas import BIG, SchemaLedger, as_struct, infer_json, infer_text, join_structs, join_types
from musterline.streaming import jobs

L, D, S, B, N = T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType(), T.NullType()


@pytest.mark.parametrize(
    ("a", "b", "want"),
    [
        (N, L, L), (L, L, L), (L, BIG, BIG), (BIG, D, D), (L, D, D), (B, L, S), (T.DateType(), T.TimestampType(), T.TimestampType()),
        (T.DateType(), L, S), (T.ArrayType(L), T.ArrayType(D), T.ArrayType(D)), (T.ArrayType(L), L, S), (T.StructType([]), L, S),
    ],
)
def test_join_of_types_is_the_narrowest_for_both(a, b, want):
    assert join_types(a, b) == want == join_types(b, a)


def test_join_is_the_same_in_any_order():
    kinds = [N, L, BIG, D, S, B, T.DateType(), T.TimestampType(), T.ArrayType(L), T.ArrayType(N)]
    for a in kinds:
        for b in kinds:
            for c in kinds:
                assert join_types(join_types(a, b), c) == join_types(a, join_types(b, c))


def test_structs_keep_their_order_and_names_of_another_case_stay_out(spark):
    a, b = as_struct(spark, "x bigint, n struct<p: bigint>"), as_struct(spark, "y string, X string, n struct<q: string>, x double")
    assert join_structs(a, b).simpleString() == "struct<x:double,n:struct<p:bigint,q:string>,y:string>"


LINES = [
    '{"a":1,"b":1.5,"c":"x","e":1,"E":"t","n":{"x":1,"y":[1,2]},"z":null,"d.t":1}',
    '{"a":1.25,"b":2,"c":3,"n":{"x":"q","w":5},"new":true,"big":12345678901234567890,"y":[1,"a"],"o":[{"k":1},{"k":2,"m":3}]}',
    "broken{", "5", "[1]", '{"a":1,"a":2}', "", None, "{}", '{"a":"' + "x" * 100_000 + '"}',
]


def lines(spark):
    return spark.createDataFrame([(v, i) for i, v in enumerate(LINES)], "value string, line int")


def test_types_of_json(spark):
    found = infer_json(lines(spark).where("line < 9"))
    got = {f.name: f.dataType.simpleString() for f in found.fields}
    assert got == {
        "E": "string", "a": "double", "b": "double", "big": "decimal(38,0)", "c": "string", "d.t": "bigint", "n": "struct<w:bigint,x:string,y:array<bigint>>",
        "new": "boolean", "o": "array<struct<k:bigint,m:bigint>>", "y": "array<string>", "z": "void",
    }
    assert infer_json(lines(spark).where("line in (2, 3, 4, 6, 7)")) == T.StructType([])
    assert infer_json(lines(spark).where("false")) == T.StructType([])


def test_nothing_of_a_line_is_lost(spark):
    schema = as_struct(spark, "a bigint, b double, c string, n struct<x:bigint,y:array<bigint>>, o array<struct<k:bigint>>, t timestamp")
    got = {r.line: r for r in parse_lines(lines(spark), schema).collect()}
    assert len(got) == len(LINES)
    assert (got[0].a, got[0].b, got[0].c, got[0].n.x, got[0].n.y) == (1, 1.5, "x", 1, [1, 2])
    assert json.loads(got[0]._rescued) == {"E": "t", "e": 1, "z": None, "`d.t`": 1}
    assert (got[1].a, got[1].b, got[1].c, got[1].n.x, got[1].o) == (None, 2.0, "3", None, None)
    left = json.loads(got[1]._rescued)
    assert left == {"a": 1.25, "n.x": "q", "n.w": 5, "new": True, "big": 12345678901234567890, "y": [1, "a"], "o": [{"k": 1}, {"k": 2, "m": 3}]}
    for i in (2, 3, 4, 5, 6):
        assert got[i]._corrupt == LINES[i] and got[i]._rescued is None and got[i].a is None
    assert got[7]._corrupt is None and got[8]._corrupt is None and got[8]._rescued is None
    assert json.loads(got[9]._rescued)["a"] == "x" * 100_000


@pytest.mark.parametrize(
    ("kind", "value", "want"),
    [
        ("bigint", "1.0", None), ("bigint", '"1"', None), ("int", "2147483648", None), ("int", "7", 7), ("double", "9007199254740993", None),
        ("double", "9007199254740992", 9007199254740992.0), ("boolean", "1", None), ("boolean", "true", True), ("string", "true", "true"),
        ("string", '{"x":[1]}', '{"x":[1]}'), ("array<bigint>", "[1,null]", [1, None]), ("array<bigint>", "[1,1.5]", None),
        ("date", '"2024-02-30"', None), ("decimal(5,2)", "1.255", None), ("decimal(5,2)", "1.25", "1.25"),
    ],
)
def test_a_value_fits_only_without_loss(spark, kind, value, want):
    one = spark.createDataFrame([(f'{{"v":{value}}}',)], "value string")
    row = parse_lines(one, as_struct(spark, f"v {kind}")).first()
    got = str(row.v) if kind.startswith("decimal") and row.v is not None else row.v
    assert got == want and (row._rescued is None) == (want is not None)


def test_types_of_text(spark):
    text = [
        ("1", "1", "1.5", "2024-01-02", "2024-01-02", "true", "007", None, "9" * 30, "x"),
        ("-2", "9" * 25, "1e3", "2024-12-31", "2024-01-02 03:04:05", "FALSE", "1", None, "1", "1"),
    ]
    names = [f"c{i}" for i in range(10)]
    found = infer_text(spark.createDataFrame(text, ", ".join(f"{n} string" for n in names)))
    assert [f.dataType.simpleString() for f in found.fields] == [
        "bigint", "decimal(38,0)", "double", "date", "timestamp", "boolean", "string", "void", "decimal(38,0)", "string",
    ]


def test_versions_grow_and_hints_stay(spark, tmp_path):
    ledger = SchemaLedger(spark, str(tmp_path / "s"), "price double", reserved=["_own"])
    assert ledger.latest()[0] == 0 and ledger.versions() == []
    assert ledger.merge(as_struct(spark, "price bigint, a bigint, _own string"))[1].simpleString() == "struct<price:double,a:bigint>"
    assert ledger.merge(as_struct(spark, "a bigint"))[0] == 1
    assert ledger.merge(as_struct(spark, "a string, b double")) == (2, as_struct(spark, "price double, a string, b double"))
    again = SchemaLedger(spark, str(tmp_path / "s"), "price double")
    assert again.latest() == ledger.latest() and again.at(1).simpleString() == "struct<price:double,a:bigint>"


def test_two_writers_do_not_overwrite_each_other(spark, tmp_path, monkeypatch):
    one, two = (SchemaLedger(spark, str(tmp_path / "s")) for _ in range(2))
    stale = two.latest()
    one.merge(as_struct(spark, "a bigint"))
    answers = [stale]
    monkeypatch.setattr(two, "latest", lambda: answers.pop() if answers else SchemaLedger.latest(two))
    assert two.merge(as_struct(spark, "b string")) == (2, as_struct(spark, "a bigint, b string"))


def test_stream_goes_on_under_the_next_version(spark, tmp_path):
    landing, table = tmp_path / "l", None
    landing.mkdir()
    waves = ['{"id":1,"v":1}\n{"id":2,"v":2}', '{"id":3,"v":1.5,"w":[1]}', '{"id":4,"v":"text","w":[2.5]}\nnot json', '{"id":5}']
    for i, wave in enumerate(waves):
        (landing / f"{i}.json").write_text(wave)
        table = jobs.inferred_table(spark, str(tmp_path / "t"), str(tmp_path / "s"))
        jobs.ingest_inferred(files.line_stream(spark, str(landing)), table, str(tmp_path / "c")).awaitTermination()
    got = table.read()
    assert table.ledger.versions() == [1, 2, 3] and [f.dataType.simpleString() for f in got.schema.fields[:3]] == ["bigint", "string", "array<double>"]
    assert sorted(rows(got.where("id is not null"), "id", "v", "w")) == [
        (1, "1", None), (2, "2", None), (3, "1.5", [1.0]), (4, "text", [2.5]), (5, None, None),
    ]
    assert rows(got.where("id is null"), "_corrupt", "_source_file") == [("not json", "2.json")]
    assert rows(table.of_version(1), "v") == [(1,), (2,)]


def test_a_replayed_batch_leaves_no_second_copy_under_another_version(spark, tmp_path):
    table = jobs.inferred_table(spark, str(tmp_path / "t"), str(tmp_path / "s"))
    batch = spark.createDataFrame([('{"a":1}', "f")], "value string, _source_file string")
    version, schema = table.ledger.merge(infer_json(batch))
    table.write_batch(parse_lines(batch, schema), version, 0)
    version, schema = table.ledger.merge(as_struct(spark, "b string"))
    table.write_batch(parse_lines(batch, schema), version, 0)
    assert rows(table.read(), "a", "b") == [(1, None)]


def test_without_inference_the_hints_are_the_schema(spark, tmp_path):
    (tmp_path / "l").mkdir()
    (tmp_path / "l" / "a.json").write_text('{"a":1,"b":2}\n{"a":"x"}')
    table = jobs.inferred_table(spark, str(tmp_path / "t"), str(tmp_path / "s"), hints="a bigint")
    jobs.ingest_inferred(files.line_stream(spark, str(tmp_path / "l")), table, str(tmp_path / "c"), infer=False).awaitTermination()
    assert sorted(rows(table.read(), "a", "_rescued"), key=str) == [(1, '{"b":2}'), (None, '{"a":"x"}')]
    assert [f.name for f in table.ledger.latest()[1].fields] == ["a"]


def test_csv_types_grow_with_files_and_no_file_is_read_twice(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    load = lambda: files.load_csv(spark, str(source), None, str(tmp_path / "t"), str(tmp_path / "k"), hints="small int")
    (source / "a.csv").write_text("id,small,when\n1,2,2024-01-02\n2,,\n")
    first = load()
    assert [f.dataType.simpleString() for f in first.schema.fields] == ["bigint", "int", "date", "timestamp", "string"]
    (source / "b.csv").write_text("when,id,more\n2024-01-02 10:00:00,3.5,x\n")
    (source / "empty.csv").write_text("")
    got = load()
    assert [f.dataType.simpleString() for f in got.schema.fields[:4]] == ["double", "int", "timestamp", "string"]
    shown = got.select("id", "small", F.date_format("when", "yyyy-MM-dd HH"), "more", "_source_file")
    assert sorted(rows(shown)) == [(1.0, 2, "2024-01-02 00", None, "a.csv"), (2.0, None, None, None, "a.csv"), (3.5, None, "2024-01-02 10", "x", "b.csv")]
    before = sorted(p.name for p in (tmp_path / "t").rglob("*.parquet"))
    assert load().count() == 3 and sorted(p.name for p in (tmp_path / "t").rglob("*.parquet")) == before
