def test_evaluations_are_made_once_for_two_writes(spark, tmp_path, monkeypatch):
    import __spark_entry__ as entry
    from tidemark.queries import storage

    sf = str(tmp_path)
    spark.range(60).selectExpr("id o_orderkey", "id % 5 o_custkey", "if(id % 2 = 0, 'F', 'O') o_orderstatus", "cast(id * 1000 as double) o_totalprice", "timestamp'1999-05-01' o_orderdate", "'1-URGENT' o_orderpriority").write.parquet(f"{sf}/orders.parquet")
    spark.range(5).selectExpr("id c_custkey", "cast(id as int) c_nationkey").write.parquet(f"{sf}/customer.parquet")
    read, real = [], storage.rs.append
    monkeypatch.setattr(storage.rs, "append", lambda df, *rest: read.extend(df.inputFiles()) or real(df, *rest))
    out = entry.queries()["s6_append_results"](spark, sf).collect()
    assert len(out) == 2 * len({(r.model_id % 1000, r.segment, r.metric, r.k, r.segment_k) for r in out}) > 0
    assert read and not [f for f in read if "orders.parquet" in f]
