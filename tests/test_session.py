from pathlib import Path

import pytest

from stormgrid import session


@pytest.fixture()
def shared(spark):
    return Path(session.shared_dir(spark).removeprefix("file:"))


def test_a_run_leaves_no_steps_and_touches_no_others(spark, shared):
    kept = session.materialize(spark.range(5))
    before = set(shared.iterdir())
    with session.stored_steps(spark) as folder:
        step = session.materialize(spark.range(3))
        assert step.count() == 3 and step.inputFiles()[0].removeprefix("file://").startswith(folder.removeprefix("file:"))
    assert set(shared.iterdir()) == before and kept.count() == 5


def test_a_failed_run_leaves_no_steps(spark, shared):
    before = set(shared.iterdir())
    with pytest.raises(RuntimeError), session.stored_steps(spark):
        session.materialize(spark.range(3))
        raise RuntimeError
    assert set(shared.iterdir()) == before


@pytest.mark.parametrize("master", ["local-cluster[2,1,1024]", "yarn", "spark://host:7077"])
def test_clusters_need_a_named_folder(master):
    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    Session.sparkContext.master = master
    with pytest.raises(RuntimeError):
        session.shared_dir(Session())
