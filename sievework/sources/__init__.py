"""Readers with declared schemas."""
