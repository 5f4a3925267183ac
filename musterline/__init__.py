"""Roster analytics as PySpark DataFrame operators."""

from musterline.model import PASCAL, ROSTER_SCHEMA, SNAKE, USER_SCHEMA, RosterColumns

__all__ = ["PASCAL", "ROSTER_SCHEMA", "SNAKE", "USER_SCHEMA", "RosterColumns"]
