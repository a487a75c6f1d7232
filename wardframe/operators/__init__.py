"""Reusable temporal, rule and cohort operators over event series."""
