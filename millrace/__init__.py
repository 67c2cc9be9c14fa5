"""millrace: take raw tabular exports to trustworthy warehouse tables on Spark.

``sources`` reads landed files, ``functions`` holds Column expressions, ``operators`` turns
DataFrames into DataFrames or tables, ``plans`` composes them and registers the queries, and
``streaming`` loads new files as they arrive.
"""
