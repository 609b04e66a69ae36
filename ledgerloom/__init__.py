"""ledgerloom — a multi-tenant financial-services warehouse as PySpark jobs.

Layers: landing feeds (``sources``) -> typed staging, conformed dimensions,
facts, insert-only vault, SCD-2 history, marts and serving queries
(``operators``), wired by ``plans`` and fed by batch or streaming ingest
(``streaming``).  Column expressions live in ``functions``.
"""

__version__ = "0.1.0"
