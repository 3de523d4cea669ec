import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from alertfold.session import get_session
    s = get_session("local[4]", 4, app_name="alertfold-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Collect selected columns as a list of tuples, in the DataFrame's order."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]


def write_text(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)
    return path
