"""Customer-journey and conversion analytics as PySpark DataFrame operators."""
