"""School statistics and place codes on Spark.

Every operator is a function over DataFrames or Columns; Catalyst plans them,
and nothing but the workbook reader runs Python on the executors.
"""

__version__ = "0.1.0"
