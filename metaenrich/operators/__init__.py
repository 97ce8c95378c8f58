"""Operators: rules, matching, enrichment methods, provenance, validation and lookups."""
