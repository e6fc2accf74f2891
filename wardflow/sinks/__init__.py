"""Appending, replacing and publishing."""
