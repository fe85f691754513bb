"""Subpackage of factorloom."""
