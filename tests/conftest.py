import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tidemark-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(folder / "shared"),
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(frame, *columns):
    """Rows of a frame as sorted tuples."""
    names = columns or frame.columns
    return sorted((tuple(r) for r in frame.select(*names).collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


def column(spark, values, kind="string"):
    """One-column frame ``v`` with its position ``i``."""
    return spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")


def values(frame, expression):
    """Values of an expression over ``column`` frames, in input order."""
    return [r[0] for r in frame.orderBy("i").select(expression).collect()]


def plan_text(frame):
    """The formatted physical plan, with full pushed filters."""
    execution = frame._jdf.queryExecution()
    return frame.sparkSession._jvm.PythonSQLUtils.explainString(execution, "formatted")
