"""Operators: silver cleaning, gold metrics, profiling checks, quality gate, extensions."""
