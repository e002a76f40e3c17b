"""Readers and writers for place tables, dimensions, shapes, archives and pages."""
