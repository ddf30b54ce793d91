import sys
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from tradeloom.session import build_session  # noqa: E402

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="3",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="6g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from tradeloom.workload.queries import catalog

    return catalog(spark, TABLES)


@pytest.fixture
def warehouse(spark, tmp_path):
    import uuid

    from tradeloom.sources.warehouse import Warehouse

    w = Warehouse(spark, str(tmp_path / "layers"), f"t{uuid.uuid4().hex[:8]}_")
    w.ensure_layers()
    return w


def day(text):
    return date.fromisoformat(text) if text else None


def dec(text):
    return Decimal(text) if text is not None else None
