"""Schema discovery against Spark's own readers."""
from pyspark.sql import functions as F

from quarry.operators.discovery import discover, widest


def found(spark, zone):
    return {a: [(r.column_name, r.data_type) for r in sorted(rows, key=lambda r: r.position)]
            for a, rows in _by_asset(discover(spark, zone).collect()).items()}


def _by_asset(rows):
    out = {}
    for r in rows:
        out.setdefault(r.asset, []).append(r)
    return out


def test_mixed_files_of_all_formats(spark, tmp_path):
    zone = f"{tmp_path}/a zone"
    base = spark.range(40).select(F.col("id").cast("int").alias("k"), (F.col("id") / 4).alias("x"), F.col("id").cast("string").alias("s"),
                                  F.lit("2024-01-02").cast("date").alias("d"), F.lit("2024-01-02 03:04:05").cast("timestamp").alias("at"), (F.col("id") > 3).alias("b"))
    for fmt in ("parquet", "orc"):
        base.write.format(fmt).save(f"{zone}/{fmt}_asset")
        base.select(F.col("k").cast("long").alias("k"), "x", F.col("k").alias("s"), "d", F.col("d").alias("more")).write.mode("append").format(fmt).save(f"{zone}/{fmt}_asset")
        assert found(spark, zone)[f"{fmt}_asset"][:4] == [("k", "bigint"), ("x", "double"), ("s", "string"), ("d", "date")]
    base.repartition(3).write.json(f"{zone}/json_asset")
    (tmp_path / "a zone/json_asset/odd.json").write_text('{"k": "text", "new": null, "deep": {"A": 1.5, "l": [1, 2.5]}}\n[1]\nno json\n\n{"deep": {"A": 2}}\n')
    base.repartition(3).write.option("header", "true").csv(f"{zone}/csv_asset")
    (tmp_path / "a zone/csv_asset/z.csv").write_text('\nk,x,s,d,at,b,extra\n,1,"a ""q"", b",2024-01-02 00:00:00,,,99999999999\n\n7,,,,,,,beyond\n')
    got = found(spark, zone)
    assert got["json_asset"] == [("at", "string"), ("b", "boolean"), ("d", "string"), ("deep", "struct<A:double,l:array<double>>"), ("k", "string"), ("new", "string"),
                                 ("s", "string"), ("x", "double")]
    assert got["csv_asset"] == [("k", "int"), ("x", "double"), ("s", "string"), ("d", "timestamp"), ("at", "timestamp"), ("b", "boolean"), ("extra", "bigint")]
    assert got["parquet_asset"] == [("k", "bigint"), ("x", "double"), ("s", "string"), ("d", "date"), ("at", "timestamp"), ("more", "date"), ("b", "boolean")]


def test_same_as_the_readers(spark, tmp_path):
    zone = f"{tmp_path}/zone"
    df = spark.range(200).select("id", (F.col("id") * 5_000_000_000).alias("big"), F.when(F.col("id") > 150, F.col("id") / 8).alias("x"), F.lit(None).cast("string").alias("none"),
                                 F.struct(F.col("id").alias("In"), F.array(F.lit("a")).alias("ls")).alias("deep"))
    df.repartition(4).write.json(f"{zone}/j")
    df.drop("deep").repartition(4).write.option("header", "true").csv(f"{zone}/c")
    got = found(spark, zone)
    assert got["j"] == [(f.name, f.dataType.simpleString()) for f in spark.read.json(f"{zone}/j").schema]
    own = spark.read.option("header", "true").option("inferSchema", "true").csv(f"{zone}/c").schema
    assert got["c"] == [(f.name, f.dataType.simpleString()) for f in own]


def test_one_format_an_asset_and_empty_zones(spark, tmp_path):
    (tmp_path / "zone/asset").mkdir(parents=True)
    (tmp_path / "zone/asset/a.csv").write_text("x,y\n")
    (tmp_path / "zone/loose.csv").write_text("z\n1\n")
    assert found(spark, f"{tmp_path}/zone") == {"asset": [("x", "string"), ("y", "string")]}
    (tmp_path / "zone/asset/a.json").write_text('{"z": 1}\n')
    assert found(spark, f"{tmp_path}/zone/") == {"asset": [("z", "bigint")]}
    (tmp_path / "none").mkdir()
    assert found(spark, f"{tmp_path}/none") == {}


def test_widest(spark):
    cases = {("int", "bigint"): "bigint", ("int", "float"): "double", ("smallint", "float"): "float", ("int", "double", "void"): "double", ("date", "timestamp"): "timestamp",
             ("date", "int"): "string", ("void",): "string", ("boolean",): "boolean", ("boolean", "int"): "string", ("struct<a:int>",): "struct<a:int>"}
    df = spark.createDataFrame([(list(k), v) for k, v in cases.items()], "types array<string>, want string")
    assert all(r.got == r.want for r in df.withColumn("got", widest(F.col("types"))).collect())
