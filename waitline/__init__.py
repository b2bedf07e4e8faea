"""Service-level and bottleneck analytics over case event logs, on PySpark."""
