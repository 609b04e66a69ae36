"""Operators for large text corpora: sharding, counting, scoring, encoding,
extraction, fingerprints, near-duplicates, surrogates, decontamination and
chat formatting.  Nothing else in the library imports this subpackage."""
