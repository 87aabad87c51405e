"""medallion.functions: Column -> Column expressions (no actions, no Python rows).

* ``text``     -- padding, blanks, markers, whitespace, regex/literal replace,
  split parts, pt-BR decimals, alias maps (T1-T20);
* ``casts``    -- never-throwing, shape-guarded casts and cast maps (C1-C3);
* ``unaccent`` -- accent folding by a rule-built translate table (T14) and the
  optional Arrow-batched NFKD path (X1);
* ``keys``     -- SHA-1 / MD5, name key, id+segment key (H1, H2, Y1, Y2).
"""
