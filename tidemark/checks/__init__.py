"""Inputs derived from the test tables, registered queries and their SQL counterparts."""
