from riskloom.sources.testtables import CreditTables


def test_a_part_of_the_wide_table_is_drawn_without_the_rest(spark, tmp_path):
    rows = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    keys = [*range(30), 7, None]
    spark.createDataFrame([(k, "n", 1, 1.0, "s") for k in keys], rows).write.parquet(f"{tmp_path}/customer.parquet")
    t = CreditTables(spark, str(tmp_path))
    narrow = {"lookup": t.lookup, "model_inputs": t.model_inputs}
    assert "wide" not in t.__dict__
    for part in narrow.values():
        again = t.wide.select(*part.columns)
        assert part.dtypes == again.dtypes and part.count() == len(keys)
        assert part.exceptAll(again).count() == 0
    # Once the table is stored, parts are read from it.
    t.__dict__.pop("model_inputs")
    assert set(t.model_inputs.inputFiles()) == set(t.wide.inputFiles())
