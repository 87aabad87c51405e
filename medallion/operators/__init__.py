"""medallion.operators: DataFrame operators of the layer jobs.

* ``project``   -- rename, select, drop, schema difference, derived columns (P1-P9, F1, F3);
* ``dedup``     -- distinct, key-subset dedup, first row per key (G3, G4, W1);
* ``joins``     -- equi-joins and null-aware anti-joins (J1-J6, F2);
* ``union``     -- unions by column name (U1, U2);
* ``quality``   -- counts, column profile, key / contract / cast audits (G1, G2, R1, R2, R5-R7);
* ``reconcile`` -- name reconciliation and override tables (R3, R4).
"""
