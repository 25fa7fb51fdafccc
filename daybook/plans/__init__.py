"""Composed jobs (several operators) and the registry of runnable queries."""
