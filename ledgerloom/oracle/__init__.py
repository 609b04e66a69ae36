"""DuckDB-dialect SQL twins of the Spark jobs, used only as a correctness
oracle.  Each oracle statement starts with the fixture rules as CTEs over
the driver's views, followed by the transform under test."""

from .cte import CTES, with_ctes

__all__ = ["CTES", "with_ctes"]
