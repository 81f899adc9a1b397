"""Relation-to-relation operators."""
