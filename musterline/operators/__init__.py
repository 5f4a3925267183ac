"""Lazy DataFrame operators over the roster."""
