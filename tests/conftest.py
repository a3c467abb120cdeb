import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for folder in (ROOT, os.path.join(ROOT, "tools")):
    if folder not in sys.path:
        sys.path.insert(0, folder)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from driftwise.session import local_session

    # Forked Python workers import the package too.
    os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(8, "driftwise-tests", **{"spark.checkpoint.dir": shared})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SMALL):
        pytest.skip("test tables are absent")
    return SMALL


@pytest.fixture(scope="session")
def renewal_rows(spark, sf_dir):
    """Complete scored renewals, written once."""
    from driftwise.plans.bindings import complete, scored
    from driftwise.session import stage

    return stage(complete(scored(spark, sf_dir)), "test-rows")
