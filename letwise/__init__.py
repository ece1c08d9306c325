"""letwise: rental-listing analytics as Spark DataFrame jobs.

Packages: ``functions`` (column expressions), ``sources`` (readers/writers, versioned
snapshots), ``operators`` (clean, dedup, upsert, availability, geo, audits),
``plans`` (registered queries over the test tables and the batch pipeline),
``streaming`` (incremental ingest and upsert).
"""

__version__ = "0.1.0"
