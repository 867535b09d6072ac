"""DataFrame operators: landing, shaping, cleansing, reference data, marts, serving, quality."""
