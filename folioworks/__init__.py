"""Content-catalogue ELT and analytics on Spark DataFrames."""
