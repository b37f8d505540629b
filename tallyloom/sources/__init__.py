"""Readers: everything arrives as text."""
