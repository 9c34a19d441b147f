"""Urban-mobility analytics as PySpark DataFrame functions."""
