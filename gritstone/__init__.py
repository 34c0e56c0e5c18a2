"""Plant telemetry analytics as PySpark jobs: DataFrames in, DataFrames out."""
