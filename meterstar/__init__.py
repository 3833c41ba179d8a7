"""Trip-record analytics on PySpark: star schema, quality checks, reports."""
