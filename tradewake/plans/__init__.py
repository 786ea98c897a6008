"""Registered queries, one module per subject."""
