"""Forecasters: fitted, stored and scored as Spark jobs."""
