"""DataFrame operators: clean, infer, load, verify, merge, calendar reports."""
