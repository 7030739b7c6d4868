"""Operators for preparing training text: filters, classifiers, tokenizing and deduplication."""
