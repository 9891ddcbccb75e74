"""Usage analytics for shared lab machines, written as plain Spark DataFrame functions."""
