"""Analytics operators on Spark DataFrames.

Feature engineering, ranking metrics, similarity search, detection labels,
ensemble data flow, kernel analysis and incremental file loads. Every operator
takes and returns DataFrames; nothing whole passes through the driver.
"""

from tidewright.session import checkpoint_dir, get_session, scratch_path

__all__ = ["checkpoint_dir", "get_session", "scratch_path"]
