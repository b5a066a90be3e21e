"""Service quality of public transport on PySpark."""
