"""DuckDB texts of the registered queries, one file per query plus the shared tables."""

from __future__ import annotations

from pathlib import Path

FOLDER = Path(__file__).resolve().parents[2] / "oracle"
COMMON = "_common"


def oracle_texts() -> dict[str, str]:
    common = (FOLDER / f"{COMMON}.sql").read_text()
    return {
        path.stem: f"{common}{path.read_text()}"
        for path in sorted(FOLDER.glob("*.sql"))
        if path.stem != COMMON
    }
