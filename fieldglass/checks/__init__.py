"""Every operator as a query over the test tables, with the same result spelled out in SQL where SQL can.

``queries()`` and ``oracle_sql()`` of ``__spark_entry__`` are views of the table filled here.
"""
