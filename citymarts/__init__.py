"""citymarts — daily city indicators from checksummed JSON evidence, on Spark.

Layers (each a set of DataFrame -> DataFrame functions):

* ``sources``    envelope scan, raw load, dimensions, sinks
* ``functions``  Column-level helpers (clamp, bucket, hashing, time parsing)
* ``operators``  reusable DataFrame operators (latest-wins, unnest, rollups,
                 lag %-change, scoring, quality gates, geo catchment)
* ``plans``      fact builders, mart builders, serving queries, the refresh chain
* ``streaming``  incremental raw sync and streaming latest-wins upsert
"""

__version__ = "0.1.0"
