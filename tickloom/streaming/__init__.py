"""Cursor source, refresh state and streaming bars."""
