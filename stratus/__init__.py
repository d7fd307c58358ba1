"""stratus — keyed sensor-reading analytics on Spark DataFrames.

Everything here is built from public PySpark DataFrame / SQL / Structured
Streaming APIs: each public function takes DataFrames (and plain Python
parameters) and returns a lazy DataFrame, so Catalyst plans the whole chain.
"""

from stratus.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
