"""Operations for training-data pipelines, built on Spark DataFrames.

Nothing else in the library imports this subpackage.  ``queries()`` and
``oracle_sql()`` give the registered queries and their DuckDB counterparts.
"""

from scrubline.llm.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
