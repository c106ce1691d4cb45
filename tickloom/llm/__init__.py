"""Operators for preparing training text: deduplication, tokens, packing, filters and scans."""
