"""Composite jobs: whole reports as one lazy plan each."""
