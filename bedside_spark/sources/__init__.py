"""Readers: live readings, cohort lists, the patient dimension, derived tables."""
