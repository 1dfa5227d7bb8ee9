"""Relational operators: lists, hierarchies, graphs, navigation, containment, quality checks."""
