"""Registered queries: inputs derived from the supplied tables, run through the operators."""
