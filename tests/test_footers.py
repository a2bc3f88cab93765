"""Footers as a table, and builds checked by them."""

from pyspark.sql import functions as F

from sedimenta.operators.build import write_parquet
from sedimenta.operators.contract import ColumnRule, Contract, tagged
from sedimenta.sources.footers import build_faults, column_facts, parquet_footers

CONTRACT = Contract("small", (ColumnRule("id", "bigint", False), ColumnRule("name", "string")))


def faults(spark, path, rows=1000, most=400):
    found = build_faults(parquet_footers(spark, path, 3), ["id", "name"], "small", "ZSTD", rows, most, ["id"])
    return {r.check: r.violations for r in found.collect() if r.violations}


def rows(spark):
    return tagged(spark.range(1000).repartition(3).withColumn("name", F.when(F.col("id") % 4 != 0, F.concat(F.lit("n"), "id"))), CONTRACT)


def test_sound_build(spark, tmp_path):
    path = f"file://{tmp_path}/sound"
    write_parquet(rows(spark), path)
    assert faults(spark, path) == {}
    facts = {r.column: r for r in column_facts(parquet_footers(spark, path)).collect()}
    assert (facts["id"].rows, facts["id"].nulls, facts["name"].nulls, facts["id"].row_groups) == (1000, 0, 250, 3)
    ids = parquet_footers(spark, path).where("column = 'id'").collect()
    assert min(int(r.least) for r in ids) == 0 and max(int(r.greatest) for r in ids) == 999 and {r.codec for r in ids} == {"ZSTD"}


def test_each_damage_is_found(spark, tmp_path):
    def write(name, df, **options):
        path = f"file://{tmp_path}/{name}"
        df.write.options(**({"compression": "zstd"} | options)).parquet(path)
        return faults(spark, path)

    assert write("codec", rows(spark), compression="snappy") == {"codec": 6}
    assert write("fewer", rows(spark).where("id <> 7")) == {"rows": 1}
    assert write("names", rows(spark).select("name", "id")) == {"columns": 3}
    assert write("bare", spark.range(1000).repartition(3).withColumn("name", F.lit("n"))) == {"contract": 3}
    assert write("nulls", tagged(rows(spark).withColumn("id", F.when(F.col("id") > 9, F.col("id"))), CONTRACT)) == {"nulls": 10}
    assert write("large", rows(spark).coalesce(1)) == {"row groups": 1}


def test_no_files_and_empty_files(spark, tmp_path):
    (tmp_path / "none").mkdir()
    assert faults(spark, f"file://{tmp_path}/none") == {"no files": 1, "rows": 1000}
    write_parquet(rows(spark).where("id < 0").coalesce(1), f"file://{tmp_path}/empty")
    assert faults(spark, f"file://{tmp_path}/empty") == {"rows": 1000}
    assert column_facts(parquet_footers(spark, f"file://{tmp_path}/empty")).count() == 0
