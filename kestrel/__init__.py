"""kestrel: sensor-series, drift-monitoring, feature-store and tabular-ML operators on Spark.

Modules
-------
kestrel.session      session settings and the shared checkpoint folder
kestrel.fixed        fixed values shared with the original pipelines
kestrel.sources      table scans, derived input views, pluggable sources
kestrel.operators    DataFrame -> DataFrame operators (drift, profile, series, anomaly,
                     objects, features, ml, runs, vectors, sinks, quantiles, cumulative)
kestrel.functions    built-in column expressions (strings, dates, math, rounding)
kestrel.streaming    Structured Streaming jobs (ingest, monitors, imports, results)
kestrel.plans        the registered queries and their SQL oracles
"""
