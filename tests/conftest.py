from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from plumbline.session import build


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    home = tmp_path_factory.mktemp("spark")
    return build("local[4]", 4, spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__sql__warehouse__dir=f"file://{home}/warehouse", spark__driver__memory="4g")
