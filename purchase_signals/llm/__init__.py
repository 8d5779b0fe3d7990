"""Training-data operators: ten text and vector operators and their queries.

Nothing else in the package imports this subpackage.  Each operator module
takes DataFrames and returns DataFrames; ``queries`` binds them to the given
tables.  Intermediate tables go to the shared folder in ``spark.checkpoint.dir``.
"""
