"""Fact builders, mart builders, serving queries and the refresh chain."""
