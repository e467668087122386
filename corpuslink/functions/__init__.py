"""Reusable Column expressions."""
