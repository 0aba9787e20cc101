"""Order-commerce analytics on PySpark."""
