"""Market-tick analytics as plain PySpark DataFrame functions."""
