"""Composite plans (the end-to-end feature job) and the query registry."""
