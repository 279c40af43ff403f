"""Stream and batch analytics jobs on PySpark.

Every operator takes DataFrames and returns DataFrames; Catalyst plans the work.
"""
