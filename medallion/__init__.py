"""medallion: layered (raw -> trusted -> delivery) data work on Spark.

Sub-packages:

* ``functions`` -- Column -> Column cleaners, casts, hashes and keys;
* ``sources`` / ``sinks`` -- delimited text, parquet and JDBC I/O;
* ``operators`` -- projection, de-duplication, joins, unions, quality checks,
  reconciliation;
* ``plans`` -- the layer jobs, the SQL surface and the query catalogue;
* ``streaming`` -- incremental ingestion of a landing folder into the raw layer.
"""

__version__ = "0.1.0"
