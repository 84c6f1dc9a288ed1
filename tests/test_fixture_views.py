import pytest
from pyspark.sql import functions as F

from retailpot.plans import fixture_views as fx
from retailpot.plans.lake import padded
from retailpot.session import shared_root


def test_long_keys_stay_distinct(spark, tmp_path):
    raw = {n: spark.read.parquet(f"/root/testdata/sf0.001/{n}.parquet") for n in ("customer", "supplier")}
    raw["customer"] = raw["customer"].withColumn("c_custkey", F.col("c_custkey") + 99_990)
    for name, df in raw.items():
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    ids = fx.load_view(spark, str(tmp_path), "fx_outlet_master").select("Outlet_ID")
    assert ids.distinct().count() == ids.count()
    assert [r[0] for r in spark.createDataFrame([(7,), (123456,)], "k long").select(padded(F.col("k"))).collect()] == ["00007", "123456"]


def test_a_cluster_without_shared_folder_is_refused():
    class Context:
        applicationId, master = "none", "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        shared_root(Session())
