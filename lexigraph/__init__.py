"""Text statistics and work tracking as Spark DataFrame operators."""
