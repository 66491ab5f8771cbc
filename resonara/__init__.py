"""Embedding analytics and recommendation as Spark jobs.

Every public function takes and returns DataFrames or Columns.  Nothing here
holds a global session; the session always comes from the caller's data.
"""

__version__ = "0.1.0"
