"""Bank-transaction categorisation on Spark DataFrames.

Every operator takes DataFrames (or Columns) and returns a DataFrame (or Column); nothing runs
until the caller writes or collects the result.
"""

__all__ = ["config", "functions", "operators", "plans", "sources"]
