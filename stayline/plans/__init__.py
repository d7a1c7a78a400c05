"""Registered queries over the test tables, each next to its SQL oracle."""
