"""Chained jobs over stored layers, and SQL over them."""
