"""Scoring operators: each is ``DataFrame -> DataFrame`` and adds one narrow ``select`` layer
(the district lookup adds a broadcast hash join of a size-checked table)."""
