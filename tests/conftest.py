import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from pitlane.session import get_spark
    s = get_spark("local[4]", app="pitlane-tests", shuffle_partitions=4)
    yield s
    s.stop()
