"""Operators over typed objects and the relations between them."""
