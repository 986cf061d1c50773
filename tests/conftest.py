import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from predlake.session import local_session
    # Tests own their checkpoint folder; a cluster names a shared one instead.
    s = local_session("*", shuffle_partitions=8, app="predlake-tests",
                      checkpoint=str(tmp_path_factory.mktemp("checkpoints")))
    yield s
