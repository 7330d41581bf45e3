"""Composite jobs over basket and hire tables."""
