"""Multi-step jobs (``pipelines``), the query catalogue (``catalog``) and the
DuckDB oracle twins of every registered query (``oracle``)."""
