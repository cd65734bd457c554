"""Training-data operators: filters, near-duplicates, packing and archives on Spark.

Nothing outside this package imports it.  Each module holds one operator with
its own interface; ``registry`` lists the queries that apply them to the test
tables.  All operators read whole texts, keep every input row (rows are never
dropped or capped to escape skew) and write intermediates only to the folder
named by ``spark.checkpoint.dir``.
"""
