"""End-to-end pipelines, the query catalog and the SQL it is checked against."""
