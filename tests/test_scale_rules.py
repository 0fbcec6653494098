"""Rules that keep the library fit for large data."""

from __future__ import annotations

import contextlib
import io
import re
from pathlib import Path

import pytest

import __spark_entry__ as entry_module
from skyledger import session

PACKAGE = Path(session.__file__).parent
FORBIDDEN = re.compile(r"\.collect\(\)|toPandas|toLocalIterator|crossJoin|localCheckpoint|\.rdd\b|pandas|@F\.udf|F\.udf\(")


@pytest.mark.parametrize("path", sorted(p for p in PACKAGE.rglob("*.py") if p.parent.name != "llm"), ids=lambda p: p.name)
def test_library_keeps_data_on_the_executors(path):
    assert not FORBIDDEN.findall(path.read_text())


@pytest.mark.parametrize("name", sorted(entry_module.CATALOGUE))
def test_plans_have_no_cross_product_and_no_python(spark, sf_dir, name):
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        entry_module.queries()[name](spark, sf_dir).explain()
    assert not re.search(r"CartesianProduct|NestedLoopJoin|Python|ArrowEval", shown.getvalue())


def test_ranking_reuses_the_aggregated_facts(spark, sf_dir):
    """Both sides of a top-k selection read one shuffle of the same aggregate."""
    df = entry_module.queries()["orbit_by_year"](spark, sf_dir)
    df.collect()
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        df.explain()
    final = shown.getvalue().split("Initial Plan")[0]
    assert "ReusedExchange" in final


def test_cluster_without_shared_folder_is_refused():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        session.shared_dir(Session())


def test_sizing_grows_with_the_input():
    small, large = session.sizing(10 * 2**30), session.sizing(100 * session.TIB)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert int(large["spark.sql.shuffle.partitions"]) == 40_960
    assert int(large["spark.sql.files.maxPartitionBytes"]) == 594 * session.MIB


def test_scratch_data_goes_to_the_configured_folder():
    class Conf:
        def get(self, key, default=None):
            return "hdfs:///shared/" if key == "spark.checkpoint.dir" else default

    class Session:
        conf = Conf()

    first, second = (session.new_workspace(Session(), "x") for _ in range(2))
    assert first.startswith("hdfs:///shared/x-") and first != second
