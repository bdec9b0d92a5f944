"""Composed jobs (pre-process, rule metrics, blacklist restore, dashboards) and
the registered query set with its SQL oracles."""
