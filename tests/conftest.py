from __future__ import annotations

import csv
import io
import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from geoledger import constants as K  # noqa: E402
from geoledger.session import build_session  # noqa: E402

from geoledger.sources.state import SNAPSHOT_SCHEMA  # noqa: E402

FIXED = {"type": "large_airport", "continent": "OC", "iso_country": "PG", "scheduled_service": "yes"}
CODES = {"iata_code": 3, "icao_code": 4}


def cell(column: str, number: int) -> str:
    """A value that fits the column and differs by number."""
    kind = SNAPSHOT_SCHEMA[column].dataType.typeName()
    if column in FIXED:
        return FIXED[column]
    if column in CODES:
        return chr(ord("K") + number % 10) * CODES[column]
    if kind == "double":
        return str(number + (0.25 if column == "latitude_deg" else 40.75))
    return {"long": f"{number}", "integer": f"{50 * number}"}.get(kind, f"{column} {number}")


def row(**changes: object) -> dict[str, str]:
    """A row that passes all rules; its id numbers the other values."""
    number = str(changes.get("id", 1))
    made = {c: cell(c, int(number) if number.isdigit() else 1) for c in K.SOURCE_COLUMNS}
    return made | {c: str(v) for c, v in changes.items()}


def mixed_rows(*kinds: str) -> list[dict[str, str]]:
    """One row of each kind, numbered from 1; only the kinds that get names have the short code."""
    kinds = kinds or ("large_airport", "small_airport", "closed", "medium_airport")
    return [
        row(id=n, type=kind, **({} if kind in K.TARGET_TYPES else {"iata_code": ""})) for n, kind in enumerate(kinds, 1)
    ]


def csv_text(rows: list[dict[str, str]], columns=K.SOURCE_COLUMNS) -> str:
    out = io.StringIO()
    lines = csv.writer(out, lineterminator="\n")
    lines.writerows([columns, *([r[c] for c in columns] for r in rows)])
    return out.getvalue()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    settings = {
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        "spark.driver.memory": "4g",
    }
    session = build_session("tests", f"local[{min(8, os.cpu_count() or 4)}]", **settings)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def write(tmp_path):
    def put(text: str, name: str = "places.csv") -> str:
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
        return str(path)

    return put


@pytest.fixture
def places(spark):
    """Typed places from rows of text."""
    from geoledger.operators.quality import type_rows

    def build(rows: list[dict[str, str]]):
        schema = ", ".join(f"{name} string" for name in K.SOURCE_COLUMNS)
        raw = spark.createDataFrame([tuple(r[c] for c in K.SOURCE_COLUMNS) for r in rows], schema)
        return type_rows(raw).select(*K.SOURCE_COLUMNS)

    return build
