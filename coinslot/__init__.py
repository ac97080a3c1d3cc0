"""Commerce analytics on PySpark: batch and streaming operators over DataFrames."""
