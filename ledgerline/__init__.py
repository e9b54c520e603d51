"""ledgerline: JSON change-data-capture documents to analytics tables on Spark.

Layers (each a plain DataFrame-in / DataFrame-out function, planned by Catalyst):

* ``functions``  column expressions: JSON scalar/object extraction, guarded casts, epoch decoding
* ``sources``    landing envelope read/build, column specs, adapters from the driver tables
* ``operators``  shredding, high-water marks, latest-per-key, upsert, hierarchy walk, mart, checks
* ``plans``      snapshot store, end-to-end mart build, session and sizing helpers
* ``streaming``  Structured Streaming staging of landed files
"""

__version__ = "0.1.0"
