"""Match analytics as Spark DataFrame operators.

``sources`` read and write tables, ``functions`` build columns, ``operators``
turn DataFrames into DataFrames, ``plans`` chain operators into daily jobs and
``streaming`` runs them incrementally.
"""
