"""Typed sources (base tables, derived fixtures) and sinks."""
