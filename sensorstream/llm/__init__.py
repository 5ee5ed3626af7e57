"""Operators for training data: scans, filters, near duplicates, encoding, packing.

Nothing else in the library imports this package.
"""
