"""Card-payment analytics as Spark DataFrame operators."""
