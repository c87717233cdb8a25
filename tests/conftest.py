import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from variantloom.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session("local[4]", 4, **{"spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.log.level": "ERROR"})
    yield spark
    spark.stop()
