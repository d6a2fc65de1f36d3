"""starloom: user-level Spark operators for dimensional ETL and analytics.

Every operator takes and returns DataFrames (or Columns), so that Catalyst sees
one declarative plan. Only sinks, quality gates, the incremental load and the
end-to-end runs start jobs.
"""

__version__ = "0.1.0"
