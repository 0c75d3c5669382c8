"""Registered queries of the structural-variant operators and their SQL twins."""
