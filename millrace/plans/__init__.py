"""Views and queries made of the operators."""
