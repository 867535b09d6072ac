"""Declared table contracts and the composed Silver, Gold and gated runs."""
