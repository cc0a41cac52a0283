"""Retail batch analytics as Spark jobs: raw CSV -> typed, clean Parquet -> answers."""
