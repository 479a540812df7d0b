"""Operations of a large-scale training-data pipeline, as Spark jobs.

Nothing else in the library imports this subpackage. Registered queries and
their SQL are in :mod:`comptoir.llm.suite`.
"""
