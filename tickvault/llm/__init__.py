"""Operators for preparing training data: packing, language id, URL and quality filters, HTML
extraction, personal data, near-duplicates, sharding, decontamination and chat formatting.

Nothing else in the library imports this subpackage. Each operator lives in its own module with
a general interface; ``queries.py`` registers one thin query per operator.
"""
