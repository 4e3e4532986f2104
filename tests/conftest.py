import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from obolus.session import local_session
    s = local_session("4", "tests", **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints"))})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
