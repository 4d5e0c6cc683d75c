"""Readers of landed payloads."""
