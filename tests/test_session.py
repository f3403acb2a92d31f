"""The shared folder, and text that holds everything a CSV cell can."""

import pytest

from tabspark import session
from tabspark.sources import readers, writers


class _Cluster:
    """A session on a cluster without a shared folder."""

    class sparkContext:  # noqa: N801
        master = "spark://somewhere:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class conf:  # noqa: N801
        @staticmethod
        def get(_, default=None):
            return default


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(_Cluster)


def test_scratch_lies_in_the_folder_of_the_application(spark):
    path = session.scratch_path(spark, "x")
    assert path.startswith(session.shared_dir(spark)) and spark.sparkContext.applicationId in path
    df = session.materialise(spark.range(3).toDF("a"), "y")
    assert df.count() == 3


def test_csv_cells_with_breaks_quotes_and_blanks(spark):
    rows = [("1", 'a\nb "q", x', "z"), ("2", None, ""), ("3", " sp ", "c\r\nd"), ("4", '""', "\\"), ("5", 'x\\"y', "a\\")]
    path = session.scratch_path(spark, "csv")
    writers.write_csv(spark.createDataFrame(rows, "k string, v string, w string"), path)
    back = readers.csv_text(spark, path, ["k", "v", "w"])
    assert sorted(map(tuple, back.collect())) == sorted(rows)
