"""Sources: day snapshots, delimited text, literal tables and test bindings."""
