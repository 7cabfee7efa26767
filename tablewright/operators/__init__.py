"""Profiling, splitting, features, models, evaluation, selection and checks."""
