"""Readers of the landing zone and writers."""
