"""Composed jobs: what a user runs from source tables to published ones."""
