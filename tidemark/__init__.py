"""Change-capture and alert analytics on PySpark."""
