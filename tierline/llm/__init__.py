"""Operators for preparing text corpora: deduplication, tokens, packing, language models, scans."""
