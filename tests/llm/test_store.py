"""Scratch tables belong to the block that made them."""

from sedimenta.llm.near_dedup import near_components
from sedimenta.llm.store import Scratch, temporary


def test_a_block_deletes_its_own_tables_only(spark):
    df = spark.createDataFrame([(i, "a b c d e f g " * (i % 3)) for i in range(12)], "doc_id long, text string")
    lazy = near_components(df)
    with temporary(spark):
        kept = near_components(df).collect()
        inner = Scratch(spark, "inner")
        table = inner.save(df)
        assert table.count() == 12
    assert sorted(map(tuple, lazy.collect())) == sorted(map(tuple, kept))  # made before the block, read after it
    path = spark._jvm.org.apache.hadoop.fs.Path(inner.root)
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    after = Scratch(spark, "after")
    assert after.save(df).count() == 12
