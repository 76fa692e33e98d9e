"""Data-quality checks, medallion refinement and KPI marts as Spark DataFrame operations."""
