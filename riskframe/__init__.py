"""riskframe: tabular risk analytics as Spark DataFrame operators.

Every operator takes and returns DataFrames; the work runs on the cluster
through built-in expressions, MLlib and a few Arrow functions.  Fitted state
(medians, bounds, levels, scaler moments) is small driver-side metadata so a
fit on training rows can be applied to any other rows.
"""

from riskframe.session import build_session, ensure_checkpoint_dir, write_checkpoint_table
from riskframe.spec import TableSpec

__all__ = ["build_session", "ensure_checkpoint_dir", "write_checkpoint_table", "TableSpec"]
