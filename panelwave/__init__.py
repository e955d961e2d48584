"""Panel-survey analytics as lazy Spark DataFrame operators."""
