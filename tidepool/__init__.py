"""tidepool: incremental lakehouse pipelines over plain Parquet, on Spark.

Subpackages: ``sources`` (feeds, tables, files), ``functions`` (column and
frame helpers), ``operators`` (merge, mutation, change feed, layout, access
report), ``streaming`` (the pipeline hops) and ``plans`` (registered queries
and their SQL oracles). Every operator is a function over DataFrames; only
writers and stream runners act.
"""
