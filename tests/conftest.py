import pytest

from claimwright.session import session

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    found = session(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
           "spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false"})
    found.sparkContext.setLogLevel("ERROR")
    return found


@pytest.fixture(scope="session")
def folder():
    return FOLDER
