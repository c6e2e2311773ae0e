"""Operators for preparing training data: classify, dedupe, decontaminate, scan, format and pack."""
