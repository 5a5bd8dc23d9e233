"""tollgate: rule-driven ledger loading on Spark.

Delimited extracts are scanned, checked against data-quality rules held in
tables, split into accepted and rejected rows with reasons and a per-value
error log, reduced to the latest file version per month, checked against
master tables and kept as validity history with a run ledger.  Every
operator is a DataFrame transformation; nothing row-level goes through the
driver.
"""

from tollgate.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
