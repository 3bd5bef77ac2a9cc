"""quayside — supply-chain order-decision and material-dimension operators on Spark.

Every operator is a plain ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions``; parameters (run date, thresholds, horizons,
message texts) are explicit arguments.  Sub-packages:

* ``sources``   — readers (snapshot / change log / history / CSV / inline) and sinks
* ``functions`` — scalar column expressions (safe division, fiscal labels, units, texts)
* ``operators`` — composite operators (latest-per-key, as-of join, alerts, merge, dimension)
* ``plans``     — the two end-to-end jobs, the test-table binding and the query registry
* ``llm``       — training-data operators; nothing else imports them
"""

__version__ = "0.1.0"
