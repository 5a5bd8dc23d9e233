"""Independent DuckDB statements of the expected results.

Each entry restates one registered query in plain SQL over the test tables
(``lineitem``, ``orders``, ``supplier``, ``nation``, ``events`` views).  The
fixtures are rebuilt here from the same definitions, not from the library.
"""

from oracle.sql import ORACLES

__all__ = ["ORACLES"]
