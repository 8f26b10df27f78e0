"""Span analytics on PySpark: metric derivation, mergeable rollups, thresholds and personal-data handling."""
