"""The expected result of each query, as SQL over the given tables.

``tables.sql`` defines the derived fleet tables and ``checks.sql`` the outcome of the
request checks; ``queries.sql`` has one block per query.  A ``$NAME`` stands for a
value of ``guardwork.fixed``, written as an SQL literal.
"""

from __future__ import annotations

import re
from pathlib import Path
from string import Template

from guardwork import fixed

_FOLDER = Path(__file__).parent


def _literals() -> dict[str, str]:
    values = {k: v for k, v in vars(fixed).items() if isinstance(v, str) and k.isupper()}
    return {k: "'" + v.replace("'", "''") + "'" for k, v in values.items()}


def oracle_queries() -> dict[str, str]:
    """SQL text by query name."""
    tables = (_FOLDER / "tables.sql").read_text()
    checks = (_FOLDER / "checks.sql").read_text()
    parts = re.split(r"^-- query: (\w+)\n", (_FOLDER / "queries.sql").read_text(), flags=re.M)
    values = _literals()
    return {
        name: Template(f"WITH {tables},\n{checks}\n{body.strip()}").substitute(values)
        for name, body in zip(parts[1::2], parts[2::2], strict=True)
    }
