"""Event studies over news and market bars on PySpark."""
