import os

import pytest

from corpusmill import session as S


def test_materialise_and_drop(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    m = S.materialise(df, "probe")
    assert m.schema == df.schema and {tuple(r) for r in m.collect()} == {(1, None), (2, "x")}
    folder = os.path.dirname(m.inputFiles()[0]).removeprefix("file://").removeprefix("file:")
    assert os.path.isdir(folder) and folder.startswith(S.scratch_root(spark).removeprefix("file://"))
    assert S.drop_scratch(spark) >= 1 and not os.path.isdir(folder)


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        S.scratch_root(Session())


def test_partitioning(spark):
    df = spark.range(10).coalesce(1)
    assert S.spread(df).rdd.getNumPartitions() == 4 and S.spread(spark.range(10, numPartitions=9)).rdd.getNumPartitions() == 9
    assert S.wide(df, "id").rdd.getNumPartitions() == 4
    assert S.bounded(df, 10) and not S.bounded(df, 9)
