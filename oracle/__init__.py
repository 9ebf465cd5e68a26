"""Independent DuckDB formulation of the facts and views (the correctness oracle).

Written directly as SQL over the driver's pre-registered ``events`` view; it
shares no code with the Spark jobs. ``sql(name)`` returns a complete query.
"""

from oracle.queries import ORACLE_QUERIES, sql  # noqa: F401
