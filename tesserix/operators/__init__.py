"""Relation-in, relation-out operators."""
