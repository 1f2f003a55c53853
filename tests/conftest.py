import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from estatelens.session import get_spark

    s = get_spark(master="local[4]", shuffle_partitions=4, app_name="estatelens-tests",
                  checkpoint_dir=str(tmp_path_factory.mktemp("checkpoints")))
    yield s
    s.stop()
