import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallywatch import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session.build("local[4]", 4, **{
        "spark.driver.memory": "6g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.log.level": "ERROR", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    yield spark
    spark.stop()
