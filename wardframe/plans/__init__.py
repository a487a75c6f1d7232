"""Concept tables and label extraction, composed from the operators."""
