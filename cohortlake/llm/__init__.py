"""Operators over training data: filters, scans, near-duplicates, mixing and tokenising."""
