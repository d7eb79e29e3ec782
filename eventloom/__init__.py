"""Event-archive analytics as composable PySpark DataFrame operators."""
