"""Nested resource documents: building, checking, flattening."""
