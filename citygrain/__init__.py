"""citygrain: urban housing analytics expressed as PySpark DataFrame operators."""
