"""Training-data operators: ten corpus operators, their queries and their SQL.

Nothing else in the library imports this subpackage; ``__spark_entry__``
registers ``QUERIES`` and ``ORACLE_SQL`` from :mod:`cloudloom.llm.queries`
only when the subpackage is present.
"""
