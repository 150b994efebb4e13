"""Trip-record warehouse on PySpark: load, stage, join, roll up and check."""
