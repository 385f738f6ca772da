"""Registered queries: each runs an operator over the stand-in views, most with a SQL check."""
