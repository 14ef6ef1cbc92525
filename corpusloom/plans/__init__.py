"""Operators put together into whole workflows."""
