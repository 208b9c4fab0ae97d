from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

from sievework.plans import census  # noqa: E402
from sievework.session import create_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = create_session(
        "sievework-tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# The eight published observations of the sample extract.
SAMPLE_ROWS = [
    ("E06000057", "Northumberland", "1", "Female", "0", "Aged under 1 year", 36000),
    ("E06000057", "Northumberland", "2", "Male", "0", "Aged under 1 year", 38000),
    ("E06000057", "Northumberland", "1", "Female", "16", "Aged 16 years", 101000),
    ("E06000057", "Northumberland", "2", "Male", "16", "Aged 16 years", 98000),
    ("E08000025", "Birmingham", "1", "Female", "0", "Aged under 1 year", 119000),
    ("E08000025", "Birmingham", "2", "Male", "0", "Aged under 1 year", 125000),
    ("E08000025", "Birmingham", "1", "Female", "16", "Aged 16 years", 363000),
    ("E08000025", "Birmingham", "2", "Male", "16", "Aged 16 years", 355000),
]
SAMPLE_TOTALS = {"E06000057": 273000, "E08000025": 962000}

# One row of each outcome, and a second one of every kind of duplicate.
FAULT_ROWS = [
    ("W7", "Harbour", "9", "Other", "30", "Thirties", 415),
    ("W7", "Harbour", "9", "Other", "30", "Thirties", 415),
    ("W8", "Hill", "9", "Other", "40", "Forties", 77),
    ("W8", "Hill", "9", "Other", "40", "Forties", 78),
    ("W9", "Marsh", "9", "Other", "   ", "Nobody", 3),
    ("W9", "Marsh", "9", "Other", "50", "Fifties", -12),
    ("W9", "Marsh", "9", "Other", "60", "Sixties", None),
]


def csv_text(header, rows) -> str:
    lines = [",".join(header)]
    lines += [",".join("" if v is None else str(v) for v in row) for row in rows]
    return "\n".join(lines) + "\n"


@pytest.fixture
def sample_csv(tmp_path) -> str:
    path = tmp_path / "extract.csv"
    path.write_text(csv_text(census.RAW_HEADERS, SAMPLE_ROWS))
    return str(path)


def metadata_document(names=census.RAW_HEADERS, measure_type="integer") -> dict:
    return {
        "@context": "http://www.w3.org/ns/csvw",
        "url": "extract.csv",
        "tableSchema": {
            "columns": [
                {
                    "name": name,
                    "datatype": measure_type if name == census.RAW_HEADERS[-1] else "string",
                    "required": True,
                }
                for name in names
            ],
            "primaryKey": [census.RAW_HEADERS[0], census.RAW_HEADERS[2], census.RAW_HEADERS[4]],
        },
    }
