"""Readers of the text formats of the domain, and the partitioned store."""
