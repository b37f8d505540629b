"""Public-data curation and poll analytics as Spark DataFrame operators."""
