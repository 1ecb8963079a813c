"""Readers for landed files, curated tables and the device dimension."""
