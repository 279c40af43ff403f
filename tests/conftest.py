import glob
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewater.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions=2, spark__ui__enabled="false",
        spark__driver__memory="6g", spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lines(spark, tmp_path):
    """A folder watched by streams and a function that drops one file of lines into it."""
    folder = tmp_path / "lines"
    folder.mkdir()

    def drop(*rows):
        number = len(glob.glob(f"{folder}/*.txt"))
        hidden = folder / f".{number}"
        hidden.write_text("".join(f"{r}\n" for r in rows))
        os.utime(hidden, (1_700_000_000 + number, 1_700_000_000 + number))
        hidden.rename(folder / f"{number:04d}.txt")

    return str(folder), drop


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
