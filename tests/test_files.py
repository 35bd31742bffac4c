from __future__ import annotations

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as S

from kinspan.sinks import files as K
from kinspan.sinks import tables as B
from kinspan.sources import files as P
from kinspan.sources import schema as D
from kinspan.sources import text as X


def path_of(tmp_path, name):
    return str(tmp_path / name)


def test_cells_need_four_fields(spark):
    lines = spark.createDataFrame([("a,b,c,d",), ("a,b,c",), ("a,b,c,d,e",), ("a,b,c,",)], "value string")
    assert rows(X.parse_cells(lines)) == [("a", "b", "c", "d")]


def test_vertex_pairs_and_pairs(spark):
    lines = spark.createDataFrame([("k|n|x",), ("k2",)], "value string")
    assert rows(X.parse_vertex_pairs(lines, 0, 1, "|")) == [("k", "n")]
    assert rows(X.parse_pairs(lines, "|")) == [("k", "n")]


def test_key_lists_are_numbered_without_gaps(spark, tmp_path):
    path = path_of(tmp_path, "keys")
    spark.range(1000).selectExpr("cast(id % 37 as string) as value").repartition(5).write.text(path)
    keys = X.read_keys(spark, path).collect()
    assert sorted(r.seq for r in keys) == list(range(1000))


def test_manifest(spark, tmp_path):
    for name, text in {"a.txt": "1\n2\n", "b.txt": "3\n", "c.txt": "4\n"}.items():
        (tmp_path / name).write_text(text)
    (tmp_path / "manifest").write_text(f"{tmp_path}/a.txt\n{tmp_path}/b.txt\n\n")
    lines = X.read_manifest(spark, path_of(tmp_path, "manifest"))
    got = {(r.value, r.file_path.rsplit("/", 1)[1]) for r in lines.collect()}
    assert got == {("1", "a.txt"), ("2", "a.txt"), ("3", "b.txt")}


SCHEMA = S.StructType(
    [
        S.StructField("id", S.LongType()),
        S.StructField("name", S.StringType()),
        S.StructField("marks", S.ArrayType(S.IntegerType())),
    ]
)


def test_csv_options(spark, tmp_path):
    (tmp_path / "in.csv").write_text("1;'a;b';3|4\n2;'it\\'s';\nx;c;5\n4;d\n")
    path = path_of(tmp_path, "in.csv")
    options = {"sep": ";", "quote": "'", "array_sep": "|"}
    good = X.read_csv(spark, path, SCHEMA, ignore_errors=True, **options)
    assert rows(good) == [(1, "a;b", [3, 4]), (2, "it's", None)]
    named = X.read_csv(spark, path, SCHEMA, ignore_errors=True, columns=["name"], **options)
    assert rows(named) == [("a;b",), ("it's",)]
    with pytest.raises(Exception, match="MALFORMED"):
        X.read_csv(spark, path, SCHEMA, columns=["name"], **options).collect()


def test_csv_arguments(spark):
    with pytest.raises(ValueError, match="mandatory"):
        X.read_csv(spark, "", SCHEMA, array_sep="|")
    with pytest.raises(ValueError, match="one character"):
        X.read_csv(spark, "x", SCHEMA, sep="||", array_sep="|")
    with pytest.raises(ValueError, match="array delimiter"):
        X.read_csv(spark, "x", SCHEMA)


def test_schema_descriptor():
    descriptor = [
        {"offset": i, "name": name, "dataType": "STRING", "isPrimaryKey": name == "key", "searchType": "TERM_1"}
        for i, name in enumerate(X.VERTEX_FIELDS)
    ]
    schema = D.schema_from_json(json.dumps(descriptor[::-1]))
    assert tuple(schema.names) == X.VERTEX_FIELDS and len(schema) == 34
    assert D.primary_key(schema) == ["key"] and schema.names.index("key") == 5
    assert not schema["key"].nullable and schema["xm"].metadata["searchType"] == "TERM_1"
    with pytest.raises(ValueError):
        D.schema_from_json(json.dumps(descriptor[:1] * 2))


@pytest.mark.parametrize("codec", K.ORC_CODECS)
def test_orc_codecs(spark, tmp_path, codec):
    df = spark.createDataFrame([(1, "a", "x"), (2, None, "y"), (3, "c", "z")], "c1 int, c2 string, c3 string")
    K.write_orc(df, path_of(tmp_path, codec), codec)
    assert rows(P.read_orc(spark, path_of(tmp_path, codec))) == rows(df)


def test_unknown_codec(spark, tmp_path):
    with pytest.raises(ValueError):
        K.write_orc(spark.range(1), path_of(tmp_path, "x"), "RAR")


def test_nested_orc(spark, tmp_path):
    arrays = [None, [], [None], [[]], [[None]], [[1, None], [2]], [[3]]]
    df = spark.createDataFrame(list(enumerate(arrays)), "id long, array_col array<array<int>>")
    K.write_orc(df, path_of(tmp_path, "nested"))
    read = P.read_orc(spark, path_of(tmp_path, "nested"))
    assert [r.array_col for r in read.orderBy("id").collect()] == arrays
    assert read.schema["array_col"].dataType.simpleString() == "array<array<int>>"


def test_long_columns_only(spark, tmp_path):
    df = spark.createDataFrame([(1, 2, "a", 3.0), (4, None, "b", 5.0)], "x int, y long, s string, d double")
    K.write_orc(df, path_of(tmp_path, "longs"))
    longs = P.orc_long_values(P.read_orc(spark, path_of(tmp_path, "longs")))
    assert sorted((r.col, r.value) for r in longs.collect() if r.value is not None) == [("x", 1), ("x", 4), ("y", 2)]
    assert longs.count() == 4 and longs.select("row").distinct().count() == 2


def test_text_sink(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, n int")
    K.write_text(df, path_of(tmp_path, "text"))
    assert rows(spark.read.text(path_of(tmp_path, "text"))) == [("\t2",), ("a\t1",)]


def test_export_in_ranges(spark, tmp_path):
    df = spark.range(500).selectExpr("lpad(cast(id % 100 as string), 3, '0') as k")
    path = path_of(tmp_path, "export")
    assert rows(K.export_by_range(df, "k", path, 4)) == [(100,)]
    files = spark.read.text(path).groupBy(F.input_file_name().alias("f")).agg(F.min("value"), F.max("value"))
    ranges = sorted((lo, hi) for _, lo, hi in files.collect())
    assert len(ranges) == 4 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    lines = spark.createDataFrame([("a\nb",), ("c",), ("c",)], "k string")
    assert rows(K.export_by_range(lines, "k", path_of(tmp_path, "lines"))) == [(2,)]


def test_bulk_load_and_publish(spark, tmp_path):
    df = spark.range(300).selectExpr("concat('e', id % 3) as edge_id", "id as time", "'v' as value")
    staging, target = path_of(tmp_path, "staging"), path_of(tmp_path, "out/target")
    with pytest.raises(FileNotFoundError):
        K.publish(spark, staging, target)
    K.bulk_load(df, ["edge_id", "time"], staging, 4)
    K.publish(spark, staging, target)
    assert spark.read.parquet(target).count() == 300
    assert not (tmp_path / "staging").exists()
    ranges = spark.read.parquet(target).groupBy(F.input_file_name().alias("f")).agg(
        F.min(F.struct("edge_id", "time")).alias("lo"), F.max(F.struct("edge_id", "time")).alias("hi")
    )
    bounds = sorted((tuple(r.lo), tuple(r.hi)) for r in ranges.collect())
    assert len(bounds) == 4 and all(a[1] < b[0] for a, b in zip(bounds, bounds[1:]))
    K.bulk_load(df, ["edge_id", "time"], staging)
    with pytest.raises(FileExistsError):
        K.publish(spark, staging, target)


def test_versions_are_frozen(spark, tmp_path):
    root = path_of(tmp_path, "table")
    P.write_version(spark.range(3), root, 1)
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        P.write_version(spark.range(4), root, 1)
    assert P.read_version(spark, root, 1, ["id"]).count() == 3


def test_event_log(spark, tmp_path):
    (tmp_path / "log").write_text('{"type":"A","event":{"x":1}}\n{"type":"B"}\n{"type":"A"}\n')
    log = X.read_event_log(spark, path_of(tmp_path, "log"))
    assert sorted(r.event_type for r in log.collect()) == ["A", "A", "B"]


def test_file_listing(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a").write_text("abc")
    (tmp_path / "sub" / "b").write_text("b")
    flat = P.list_files(spark, str(tmp_path)).select("kind", "length")
    assert rows(flat) == [("file", 3)]
    deep = P.list_files(spark, str(tmp_path), recursive=True)
    assert sorted(r.path.rsplit("/", 1)[1] for r in deep.collect()) == ["a", "b"]


def test_catalog_tables(spark):
    schema = S.StructType([S.StructField("k", S.StringType())])
    assert B.create_table_if_absent(spark, "kinspan_t", schema)
    assert not B.create_table_if_absent(spark, "kinspan_t", schema)
    assert B.table_exists(spark, "kinspan_t")
    B.drop_table(spark, "kinspan_t")
    assert not B.table_exists(spark, "kinspan_t")


def test_shared_dir_is_the_configured_one(spark):
    from kinspan.session import fresh_path, shared_dir

    configured = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == configured
    assert fresh_path(spark, "x").startswith(configured)
    assert fresh_path(spark, "x") != fresh_path(spark, "x")
