"""Derived datasets, the gate's function and name checks, egress options and extraction filters."""

import datetime
import json
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainframe.operators import catalog
from chainframe.plans import derived, gate
from chainframe.sources import arrow_types
from chainframe.sources.feed import extracted


@pytest.mark.parametrize(
    ("sql", "code"),
    [
        ("SELECT eth.decode(x), upper(y) FROM eth.logs WHERE coalesce(eth.decode(x), 1) > 0", None),
        ("SELECT upper(y) FROM eth.logs", None),
        ("SELECT eth.nothing(x) FROM eth.logs", "FUNCTION_NOT_FOUND_IN_DATASET"),
        ("SELECT x FROM eth.logs WHERE abs(other.decode(x)) > 1", "DEPENDENCY_ALIAS_NOT_FOUND"),
        ("SELECT c.eth.decode(x) FROM eth.logs", "CATALOG_QUALIFIED_FUNCTION"),
        ("SELECT `1-x`.decode(x) FROM eth.logs", "INVALID_DEPENDENCY_ALIAS_FOR_FUNCTION_REF"),
        ("SELECT x FROM eth.logs WHERE x IN (SELECT other.decode(x) FROM eth.logs)", "DEPENDENCY_ALIAS_NOT_FOUND"),
    ],
)
def test_function_references(spark, sql, code):
    assert gate.check_functions(spark, sql, {"eth": ["decode"]}) == code


def test_requests(spark):
    assert gate.check_all(spark, {}) == {"": "EMPTY_TABLES_AND_FUNCTIONS"}
    assert gate.check_all(spark, {}, {"f": 1}) == {}
    assert gate.check_all(spark, {"1 x": "SELECT 1", "ok": "SELECT FROM WHERE"}) == {"1 x": "INVALID_TABLE_NAME", "ok": "INVALID_TABLE_SQL"}


def test_deploy(spark):
    raw, own = f"raw_{uuid.uuid4().hex}", f"own_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {raw}")
    spark.createDataFrame([(1, 2.0), (2, None)], "id long, v double").write.saveAsTable(f"{raw}.t")
    twice = derived.Function("x0 * x1", ["DOUBLE", "INT"], "DOUBLE")
    sql = f"SELECT id, {own}.scaled(v, 2) AS v FROM {raw}.t"
    for written in (False, True, True):  # a table written before is replaced
        name = "kept" if written else "seen"
        derived.deploy(spark, own, {name: sql}, {"scaled": twice}, {raw: ["t"]}, written=written)
        assert sorted(spark.table(f"{own}.{name}").collect()) == [(1, 4.0), (2, None)]
    spark.createDataFrame([(3, 5.0)], "id long, v double").write.insertInto(f"{raw}.t")
    assert (spark.table(f"{own}.seen").count(), spark.table(f"{own}.kept").count()) == (3, 2)
    with pytest.raises(derived.Refused) as e:
        derived.deploy(spark, own, {"fine": sql, "bad": f"SELECT id FROM {raw}.t LIMIT 1", "none": f"SELECT * FROM {raw}.nothing"}, known={raw: ["t"]})
    assert e.value.codes == {"bad": "NON_INCREMENTAL_QUERY", "none": "TABLE_NOT_FOUND_IN_DATASET"}
    assert not spark.catalog.tableExists(f"{own}.fine")
    assert gate.output_schema(spark, {"t": sql}) == {"t": "struct<id:bigint,v:double>"}


def test_egress_options(spark, tmp_path):
    row = (2**53, bytearray([0, 255, 16]), bytearray(), datetime.date(1969, 12, 31), datetime.datetime(1969, 12, 31, 23, 59, 59, 998500), [3], None)
    df = spark.createDataFrame([row], "n long, b binary, e binary, d date, t timestamp_ntz, s array<long>, z long")
    plain = json.loads(arrow_types.to_json(df).first().value)
    assert plain == {"n": str(2**53), "b": "AP8Q", "e": "", "d": "1969-12-31T00:00:00.000Z", "t": "1969-12-31T23:59:59.999Z", "s": ["3"], "z": None}
    how = arrow_types.Egress("number", "timestamp", "array")
    arrow_types.write_json(df, f"file://{tmp_path}/out", nulls=False, how=how)
    lines = spark.read.text(f"file://{tmp_path}/out").collect()
    assert [json.loads(r.value) for r in lines] == [{"n": 2**53, "b": [0, 255, 16], "e": [], "d": -86_400_000, "t": -1, "s": [3]}]
    assert df.select(arrow_types.json_value(F.col("b"), T.BinaryType(), arrow_types.Egress(binary="hex"))).first()[0] == "00ff10"
    assert df.select(arrow_types.json_value(F.lit(None).cast("binary"), T.BinaryType(), how)).first()[0] is None


def test_extracted(spark):
    rows = spark.createDataFrame([("eth", 1), ("eth", 5), ("eth", 9), ("polygon", 5), (None, 5), ("eth", None)], "network string, block_num long")
    heads = spark.createDataFrame([("eth", 5), ("base", 9)], "network string, finalized_block long")
    assert extracted(rows).count() == 6
    assert sorted(extracted(rows, start_block=5).collect(), key=str) == sorted([("eth", 5), ("eth", 9), ("polygon", 5), (None, 5)], key=str)
    assert extracted(rows, start_block=5, finalized=heads).collect() == [("eth", 5)]
    assert extracted(rows, finalized=heads).columns == rows.columns


def test_dependencies(spark):
    versions = spark.createDataFrame([("o", "d", "1.0.0", "a" * 64, 1)], "namespace string, name string, version string, hash string, registered long")
    given = spark.createDataFrame([("a", "o/d@latest"), ("b", "o/d@2.0.0"), ("c", "o/d@latest")], "alias string, ref string")
    used = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("x", 1), ("c", 1), (None, 9)], "alias string, n long")
    got = {(r.alias, r.n): (r.version, r.code) for r in catalog.dependencies(used, given, versions).collect()}
    missing = (None, "DEPENDENCY_ALIAS_NOT_FOUND")
    assert got == {("a", 1): ("1.0.0", None), ("a", 2): ("1.0.0", None), ("c", 1): ("1.0.0", None), ("b", 1): (None, "DEPENDENCY_NOT_FOUND"), ("x", 1): missing, (None, 9): missing}


def test_files_and_progress(spark, tmp_path):
    spark.range(100).repartition(3).write.parquet(f"file://{tmp_path}/t")
    files = list((tmp_path / "t").glob("*.parquet"))
    got = catalog.files_of(spark.read.parquet(f"file://{tmp_path}/t")).first()
    assert (got.files_count, got.total_size_bytes) == (len(files), sum(f.stat().st_size for f in files))
