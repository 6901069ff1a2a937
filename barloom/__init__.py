"""barloom: market-data analytics as PySpark DataFrame functions.

Every operator takes and returns DataFrames and builds a lazy plan; actions
happen only in sinks and in explicitly named checks.
"""
