"""Versioned layer tables, scratch space, and the topics derived from the star-schema tables."""
