import pytest

WORDS = "the of and to in that is was for on with as by at from this be are or an which have has had not but were they all one their".split()


@pytest.fixture()
def prose():
    """prose(seed, n): n words, the same for the same seed."""
    import random

    def make(seed, n):
        rng = random.Random(seed)
        return " ".join(rng.choice(WORDS) + rng.choice(["", "", rng.choice(WORDS)]) for _ in range(n))

    return make


@pytest.fixture()
def frame(spark):
    """frame(rows, schema) with an odd number of partitions and a clashing extra column of each name given."""

    def make(rows, schema, extra=()):
        from pyspark.sql import functions as F

        df = spark.createDataFrame(rows, schema).repartition(3)
        return df.withColumns({c: F.lit("extra") for c in extra})

    return make
