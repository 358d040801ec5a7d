import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for folder in (ROOT, os.path.join(ROOT, "tests")):
    if folder not in sys.path:
        sys.path.insert(0, folder)

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tripflow.session import build_session

    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[*]",
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.checkpoint.dir": str(base / "shared"),
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.driver.memory": "4g",
            # Plans are read by tests: print pushed filters in full.
            "spark.sql.maxMetadataStringLength": "10000",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def no_views_left(request):
    """Views of the session are listed with the tables of any namespace, so none stays for the next test."""
    yield
    if "spark" in request.fixturenames:
        session = request.getfixturevalue("spark")
        for found in session.catalog.listTables():
            if found.isTemporary:
                session.catalog.dropTempView(found.name)


@pytest.fixture(scope="session")
def sf_dir():
    path = os.path.join(TESTDATA, "sf0.001")
    if not os.path.isdir(path):
        pytest.skip("no test tables")
    return path
