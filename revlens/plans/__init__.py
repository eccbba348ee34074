"""Query plans over whole tables: driver-table bindings, the named query
catalog with its DuckDB oracles, and whole-lab report runs."""
