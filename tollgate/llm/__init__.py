"""Training-data operators over web-scale text tables (nothing else in the library imports this)."""
