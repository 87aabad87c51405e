"""medallion.sinks: publishing layers.

* ``parquet``   -- snappy parquet with save modes, SQL COPY, catalog tables (K1-K5, K9);
* ``delimited`` -- delimited text in the sources' dialects;
* ``jdbc``      -- batched, multi-connection relational writes (K6, K7, K9).
"""
