"""DuckDB oracle SQL for every registered query.

Only the driver's raw tables are visible to the oracle, so each string
starts with ``PREFIX``: the fixture mapping and the loader's cleaning
rules written as plain SQL CTEs (an independent restatement of
``sources.fixtures`` + ``operators.cleaning``). DuckDB inlines the CTEs a
query does not use.
"""

from shiftline.oracle.prefix import PREFIX
from shiftline.oracle.queries import BODIES


def oracle_sql() -> dict[str, str]:
    return {name: PREFIX + body for name, body in BODIES.items()}
