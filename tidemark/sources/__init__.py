"""Readers, table publishing and the star-schema adapter."""
