"""arterial: city-traffic analytics as PySpark DataFrame operators."""
