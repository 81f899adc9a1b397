"""slicemill: batch warehouse operators written as plain Spark DataFrame functions."""
