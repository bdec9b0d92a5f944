"""Sources: driver tables, the derived access log, rule dimensions, raw lines."""
