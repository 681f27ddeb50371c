"""emporia: an e-commerce medallion analytics engine written as Spark plans.

Raw tables (CSV or Parquet) -> Bronze -> Silver (typed, cleaned) -> Gold
(star schema) -> business questions and data-quality checks.  Every public
function takes and returns lazy DataFrames; nothing is collected in library
code.
"""

__all__ = ["sources", "functions", "operators", "plans", "streaming"]
