import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark():
    from quire.session import session

    s = session("local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.sql.ansi.enabled": "true"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
