"""tidemark: change-data-capture analytics as plain Spark DataFrame functions."""
