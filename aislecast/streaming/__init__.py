"""Structured Streaming: landing of events and the refresh of curated days."""
