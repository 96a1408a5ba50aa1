"""vialflow: Spark-native table jobs for laboratory-campaign data.

Every operator takes DataFrames (or Columns) and returns DataFrames (or
Columns). Nothing is collected to the driver except values whose size is
bounded by construction (a handful of parameters, a small level list).
"""

__version__ = "0.1.0"
