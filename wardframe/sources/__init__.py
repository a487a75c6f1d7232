"""Schemas, readers, writers, named stages and audits."""
