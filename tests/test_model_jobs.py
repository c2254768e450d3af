from threading import Barrier

from riskloom.registry import model_queries


def test_all_models_are_fitted_at_the_same_time(spark):
    together = Barrier(3, timeout=20)

    class Run(model_queries.ModelRun):
        def __init__(self):
            self.train = spark.range(1)

        boosted_rows = property(lambda self: self.train)
        logreg = property(lambda self: (together.wait() * 0 + 1, []))
        weighted = property(lambda self: together.wait() * 0 + 2)
        balanced = property(lambda self: together.wait() * 0 + 3)

    assert Run().models == {"LogReg (stepwise)": 1, "GBT (weighted)": 2, "GBT (balanced)": 3}
