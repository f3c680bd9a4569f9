import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tagfold.session import checkpoint_dir, get_spark
    s = get_spark("local[4]", app="tagfold-tests", shuffle_partitions=4,
                  extra={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("OFF")
    checkpoint_dir(s)
    yield s
