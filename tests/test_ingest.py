"""Extract reading, bad-row budget, routing and incremental landing."""

import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promolens.session import Workspace
from promolens.sources import extracts, tables
from promolens.streaming import landing

SCHEMA = T.StructType([T.StructField("COD", T.LongType()), T.StructField("NAME", T.StringType()), T.StructField("PRICE", T.DecimalType(10, 2))])


def folder(**files):
    path = Path(tempfile.mkdtemp(prefix="promolens-test-"))
    for name, text in files.items():
        (path / f"{name}.csv").write_text(text)
    return path


def good(n):
    return "".join(f"{i}|n{i}|{i}.50\n" for i in range(n))


@pytest.mark.parametrize("head", ["", "COD|NAME|PRICE\n", "cod|Name|PRICE\n"])
def test_header_is_found(spark, head):
    df = extracts.read_extract(spark, str(folder(f=head + good(4))), SCHEMA)
    assert df.count() == 4 and float(df.agg(F.sum("PRICE")).first()[0]) == 8.0


def test_short_rows_are_kept_and_long_rows_are_bad(spark):
    path = str(folder(f=good(40) + "98|short\n" + "99|a|1.0|x|y\n" + "no|a|1.0\n"))
    counts = extracts.audit(extracts.raw_rows(spark, path, SCHEMA)).first()
    assert (counts.source_rows, counts.loaded_rows, counts.rejected_rows) == (43, 41, 2)
    df = extracts.read_extract(spark, path, SCHEMA)
    assert df.where("COD = 98").first().PRICE is None and df.count() == 41


def test_bad_row_budget(spark):
    assert extracts.read_extract(spark, str(folder(f=good(38) + "x|a|1\n" * 2)), SCHEMA).count() == 38
    with pytest.raises(Exception, match="too many bad rows"):
        extracts.read_extract(spark, str(folder(f=good(37) + "x|a|1\n" * 3)), SCHEMA).count()


def test_routing_and_batches(spark):
    names = [("20191128_M_ARTICULOS_20191128.csv", "11_M_ARTICULOS", 20191128), ("20191128_H_MARGEN_BRUTO_MES.csv", None, 20191128), ("unknown.csv", None, None)]
    df = spark.createDataFrame(names, "f string, t string, b long").select("t", "b", extracts.table_of(F.col("f")).alias("gt"), extracts.batch_of(F.col("f")).alias("gb"))
    assert all(r.t == r.gt and r.b == r.gb for r in df.collect())
    assert len(extracts.FILE_TABLES) == 16


def test_pad_and_short_lines(spark):
    df = spark.createDataFrame([("1", "a"), ("1", "a")], "x string, y string")
    assert extracts.fit_columns(df, ["p", "q", "z"]).collect() == [("1", "a", None)]
    lines = spark.createDataFrame([("a|b|c",), ("a|b",), ("a|b|c|d",)], "value string")
    assert extracts.drop_short_lines(lines, 3).count() == 2


def test_landing_takes_each_file_once(spark):
    source, target = folder(**{"20190101_a": good(5), "20190102_b": "COD|NAME|PRICE\n" + good(3)}), tempfile.mkdtemp(prefix="promolens-test-")
    run = lambda: landing.land(spark, str(source), f"{target}/out", f"{target}/state", SCHEMA)
    run()
    run()
    (source / "20190103_c.csv").write_text(good(4))
    (source / "20190104_bad.csv").write_text("x|1|2\n" * 50 + good(50))
    with pytest.raises(Exception, match="too many bad rows in 20190104_bad.csv"):
        run()
    assert landing.landed(spark, f"{target}/out").count() == 8
    landing.land(spark, str(source), f"{target}/out", f"{target}/state", SCHEMA, quarantine=f"{target}/refused")
    got = landing.landed(spark, f"{target}/out")
    assert {r.TIMESTAMP: r.n for r in got.groupBy("TIMESTAMP").agg(F.count(F.lit(1)).alias("n")).collect()} == {20190101: 5, 20190102: 3, 20190103: 4}
    audit = {r.file_name: r.accepted for r in landing.landed(spark, f"{target}/out", "audit").collect()}
    assert audit["20190104_bad.csv"] is False and len(audit) == 4
    loaded = {r.file_name: r.loaded_rows for r in landing.landed(spark, f"{target}/out", "audit").collect()}
    assert loaded == {"20190101_a.csv": 5, "20190102_b.csv": 3, "20190103_c.csv": 4, "20190104_bad.csv": 0}
    assert spark.read.parquet(f"{target}/refused").count() == 100


def test_slices_and_workspace(spark):
    path = tempfile.mkdtemp(prefix="promolens-test-") + "/t"
    df = spark.createDataFrame([("a", 1), ("b", 1)], "s string, v int")
    tables.write_table(df, path, ["s"], ["v"])
    tables.write_table(df.where("s = 'a'").withColumn("v", F.lit(2)), path, ["s"], slices_only=True)
    assert {r.s: r.v for r in spark.read.parquet(path).collect()} == {"a": 2, "b": 1}
    space = Workspace(spark)
    assert space.folder.startswith(spark.conf.get("spark.checkpoint.dir")) and space.keep(df, "x").count() == 2
