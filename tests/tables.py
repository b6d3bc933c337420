"""Names for tables of single tests."""

from __future__ import annotations

import re
from pathlib import Path


def table_name(folder: Path, name: str) -> str:
    """A name in the catalog that no other test has."""
    return re.sub(r"\W", "_", f"{folder.name}_{name}").lower()
