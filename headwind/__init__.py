"""headwind: predictions in, trusted outcomes out, as Spark DataFrame functions."""
