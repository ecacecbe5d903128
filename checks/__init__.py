"""Registered queries with their SQL oracles, bound to the provided tables."""
