"""medallion.sources: reading raw and layer data.

* ``delimited`` -- delimited text by contract and by header group, cp1252 repair,
  per-file encodings (S1-S6, U1);
* ``charset``   -- distributed encoding audit of a folder (S11);
* ``parquet``   -- layer tables, SQL scans and views over parquet (S7, S8, S12);
* ``jdbc``      -- partitioned relational reads (S9).
"""
