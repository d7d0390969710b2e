from faultline.operators.joins import heavy_join


def test_heavy_join(spark, rows):
    values = [("a", i) for i in range(500)] + [(f"k{i}", i) for i in range(300)] + [(None, 7), (None, 8), ("missing", 9)]
    table = [("a", 500, "x"), *[(f"k{i}", 1, f"y{i}") for i in range(300)]]
    left = spark.createDataFrame(values, "key string, v int")
    right = spark.createDataFrame(table, "key string, n long, name string")
    names = {k: (n, x) for k, n, x in table}
    want = sorted(((k, v, *names.get(k, (None, None))) for k, v in values), key=repr)
    for most in (1024, 10, 1):
        assert rows(heavy_join(left, right, ["key"], most=most)) == want
    assert rows(heavy_join(left, right.limit(0), ["key"])) == sorted(((k, v, None, None) for k, v in values), key=repr)
    assert heavy_join(left.limit(0), right, ["key"]).count() == 0
