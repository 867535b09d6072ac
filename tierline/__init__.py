"""tierline: trending-snapshot analytics as plain PySpark DataFrame functions."""
