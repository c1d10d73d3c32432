"""Readers, writers and the retail views over the warehouse tables."""
