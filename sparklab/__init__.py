"""sparklab: reusable analytics operators written on the PySpark DataFrame/SQL API.

Operators take DataFrames and return DataFrames; the work stays on the
executors and Catalyst/AQE choose the physical plan.
"""

from sparklab.session import get_session, checkpoint_dir
from sparklab.tables import Tables

__all__ = ["get_session", "checkpoint_dir", "Tables"]
