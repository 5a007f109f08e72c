"""collabstats: Spark-native analytics for open-source collaboration data.

Subpackages
-----------
sources     Parquet scans, sinks and the test-table adapter
functions   Column expressions (delimited lists, agency rules, rounding)
operators   DataFrame -> DataFrame steps: cleaning, commit reduction, merging,
            expansion, credit and the report tables
plans       Report shaping (pivot, order, stack) and the end-to-end jobs
streaming   Nothing: the reference has no streaming operators
"""

__version__ = "0.1.0"
