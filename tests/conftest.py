import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from feedlake.session import get_session

    s = get_session(
        "feedlake-tests",
        master="local[4]",
        shuffle_partitions=8,
        extra={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


def write_landing(directory, files: dict[str, str]) -> str:
    """Land documents as files named like the fetcher names them."""
    os.makedirs(directory, exist_ok=True)
    for name, text in files.items():
        with open(os.path.join(directory, name), "w") as fh:
            fh.write(text)
    return str(directory)
