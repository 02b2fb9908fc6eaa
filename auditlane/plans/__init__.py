"""Bindings, publish, the staged run, and the registry of checked queries."""
