"""medallion.plans: the layer jobs and everything built on them.

* ``layers``   -- trusted tables from raw (Z2-Z4), the delivery join (Z5, J3),
  the layered run with observed counts (Z1, Z7);
* ``sqlapi``   -- cleaners as SQL functions (X3), views (V1-V4), the SQL form of
  the delivery table (Z6);
* ``fixtures`` -- raw-shaped sources dressed up from the driver's tables;
* ``queries``  -- the query catalogue behind ``__spark_entry__.queries()``;
* ``oracles``  -- the independent DuckDB SQL for every query.
"""
