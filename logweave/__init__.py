"""Event-log analytics on PySpark: ordered-sequence, relational, interval, text and quality operators."""
