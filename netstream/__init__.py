"""netstream: community detection on edge tables and stream sketches on Spark.

Every public operator takes DataFrames and returns a DataFrame; nothing is
collected to the driver except k-by-k matrices in the spectral solver.
"""

from netstream.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
