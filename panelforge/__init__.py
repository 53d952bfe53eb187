"""panelforge: cross-sectional panel and time-series analytics on Spark.

Every public function maps DataFrame -> DataFrame (or returns a small
result such as a fitted model's coefficients table); none keeps a session
global. Sub-packages:

* ``sources``   readers, writers and the logical tables built from parquet
* ``functions`` column-level helpers (dates, labels, safe arithmetic)
* ``operators`` returns, ranks, labels, fences, profiling, series, models
* ``plans``     multi-step jobs and the query catalogue
"""

__version__ = "0.1.0"
