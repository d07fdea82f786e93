"""paysift: Spark-native mining of postings, baskets, salaries and texts.

Every operator is a plain function from DataFrames (or Columns) to DataFrames
(or Columns); column names are arguments.  See README.md for the map from
capabilities to modules.
"""

from .session import build_session, prepare

__all__ = ["build_session", "prepare"]
