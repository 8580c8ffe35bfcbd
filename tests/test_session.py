"""Written tables and the shared folder."""

import pytest

from paygrain import session


def test_written_tables_come_back(spark, rows):
    d = spark.createDataFrame([(1, "a b", None), (2, "é=/", 2.5), (3, "a b", 1.0)], "i int, k string, x double")
    for by in ((), ("k",)):
        got = session.materialise(d, "t", by=by)
        assert rows(got, "i", "k", "x") == rows(d) and dict(got.dtypes) == dict(d.dtypes)
    assert session.materialise(d.where("false"), "t", by=("k",)).collect() == []


def test_one_folder_per_application(spark):
    a, b = session.folder(spark, "x"), session.folder(spark, "x")
    assert a != b and a.rsplit("/", 1)[0] == b.rsplit("/", 1)[0] and spark.sparkContext.applicationId in a


def test_no_silent_local_folder_on_a_cluster():
    class Unset:
        """A session on a cluster without a shared folder."""

        class conf:
            get = staticmethod(lambda k, d: d)

        class sparkContext:
            master = "spark://host:7077"

            class _jsc:
                class sc:
                    class getCheckpointDir:
                        isDefined = staticmethod(lambda: False)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Unset)
