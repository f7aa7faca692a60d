import bisect
import random

from pyspark.sql import functions as F

from docstrata.functions.search import at_or_before


def test_equals_bisect(spark):
    r = random.Random(2)
    data = [(sorted(r.randrange(30) for _ in range(r.choice([0, 3, 12, 64, 65, 200]))), r.randrange(-2, 33)) for _ in range(400)]
    df = spark.createDataFrame([*data, (None, 1), ([1], None)], "ticks array<int>, v int")
    got = df.withColumn("n", at_or_before(F.col("ticks"), F.col("v"))).collect()
    assert all(x.n == (None if x.ticks is None or x.v is None else bisect.bisect_right(x.ticks, x.v)) for x in got)
