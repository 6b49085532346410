from millrace.session import cut


def test_the_driver_gives_back_what_plans_leave(spark, freed):
    leave, mb = freed
    cut(spark.range(10)).count()
    leave()
    before = mb()
    assert cut(spark.range(10)).count() == 10
    assert mb() < before - 100
