"""Totals of keys as large as those of larger tables."""

from gridmill.plans import catalog

ORDERS = "o_orderkey long, o_custkey long, o_totalprice double, o_orderstatus string"


def test_dataset_files_total_beyond_a_long(spark, tmp_path):
    for name, key in (("fits", 1 << 29), ("beyond", 1 << 31)):
        spark.createDataFrame([(key + i, key, 1.0, "O") for i in range(4)], ORDERS).write.parquet(f"{tmp_path}/{name}/orders.parquet")
        row = catalog.QUERIES["dataset_files"](spark, f"{tmp_path}/{name}").first()
        total = sum((key + i) * key for i in range(4))
        assert (row.n_rows, row.ids, row.files_too_large, row.enough_files) == (4, sum(key + i for i in range(4)), 0, True)
        assert row.both == (total if total < 1 << 63 else None)
