"""DataFrame -> DataFrame operators (batch and streaming where Spark allows)."""
