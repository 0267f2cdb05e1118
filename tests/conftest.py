import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
os.environ.setdefault("TZ", "UTC")

from cinderline.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, **{"spark.driver.memory": "4g", "spark.sql.codegen.cache.maxEntries": "1000"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data():
    if not Path(DATA).exists():
        pytest.skip("the driver's tables are not here")
    return DATA
