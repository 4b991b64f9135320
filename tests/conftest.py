import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cellmart.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        spark__master="local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(home / "shared"),
        spark__sql__warehouse__dir=str(home / "warehouse"),
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def bag():
    """Rows as a sorted list of reprs, for order-free comparison with duplicates."""

    def rows(df, *columns):
        return sorted(repr(tuple(r)) for r in (df.select(*columns) if columns else df).collect())

    return rows


@pytest.fixture
def plan():
    """Physical plan text, as Spark prints it."""

    def text(df):
        from contextlib import redirect_stdout
        from io import StringIO

        out = StringIO()
        with redirect_stdout(out):
            df.explain("formatted")
        return out.getvalue()

    return text
