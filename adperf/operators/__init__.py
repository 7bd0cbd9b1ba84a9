"""Lazy DataFrame operators: signals, click windows, merge, attribution, report,
evaluation, models and publishing."""
