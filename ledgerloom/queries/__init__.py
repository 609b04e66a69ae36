"""Importing this package registers every query in ``catalog.REGISTRY``."""

from . import core, ingest, quality, serving, vault  # noqa: F401
