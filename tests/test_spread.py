import pyarrow as pa
import pyarrow.parquet as pq

from loglathe.session import spread


def test_spread_deals_one_row_group_over_all_tasks(spark, tmp_path):
    """A file of one row group with more splits than cores: every task gets rows, none are lost."""
    n = 200_000
    path = str(tmp_path / "one_group.parquet")
    ids = pa.array(range(n), pa.int64())
    pq.write_table(pa.table({"id": ids, "text": pa.array([f"line {i}" for i in range(n)])}), path, row_group_size=n)
    assert pq.ParquetFile(path).metadata.num_row_groups == 1

    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {key: spark.conf.get(key) for key in keys}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    spark.conf.set("spark.sql.files.openCostInBytes", "4k")
    try:
        df = spark.read.parquet(path)
        cores = spark.sparkContext.defaultParallelism
        assert df.rdd.getNumPartitions() >= cores
        dealt = spread(df)
        sizes = dealt.rdd.glom().map(len).collect()
        assert len(sizes) >= cores
        assert min(sizes) > 0 and max(sizes) <= 2 * n / len(sizes)
        assert dealt.count() == n and dealt.agg({"id": "sum"}).first()[0] == n * (n - 1) // 2
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
