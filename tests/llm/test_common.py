from cellar.llm import _common as C


def test_tidied_hands_on_every_batch():
    assert list(C.tidied(lambda xs: (x + 1 for x in xs))(iter(range(5)))) == [1, 2, 3, 4, 5]
    assert list(C.tidied(iter)([])) == []


def test_batches_are_bounded_and_a_smaller_bound_stays(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    try:
        C.bound_batches(spark)
        assert int(spark.conf.get(name)) == C.BATCH_BYTES
        spark.conf.set(name, "1000")
        C.bound_batches(spark)
        assert spark.conf.get(name) == "1000"
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
