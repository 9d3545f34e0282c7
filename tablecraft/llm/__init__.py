"""Operators for preparing training text: near copies, filters, personal data, packing, scoring, archives."""
