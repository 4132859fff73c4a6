"""Sample store: built once per input snapshot, rebuilt when the input changes."""

import shutil

from candlewick.sources.store import fingerprint, materialised
from tests.conftest import SF001


def test_store_reused_and_keyed_by_input(spark, scratch):
    src = f"{scratch}/events.parquet"
    shutil.copy(f"{SF001}/events.parquet", src)
    builds = []

    def build():
        builds.append(1)
        df = spark.read.parquet(src).selectExpr("event_type AS family", "value")
        return {"x": df}
    a = materialised(spark, "t", [src], build)["x"]
    b = materialised(spark, "t", [src], build)["x"]
    assert len(builds) == 1 and a.count() == b.count() == spark.read.parquet(src).count()
    fp = fingerprint(spark, [src])
    spark.read.parquet(f"{SF001}/events.parquet").limit(10).write.mode("overwrite").parquet(src)
    assert fingerprint(spark, [src]) != fp
    c = materialised(spark, "t", [src], build)["x"]
    assert len(builds) == 2 and c.count() == 10
