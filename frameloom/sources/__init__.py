"""Readers: annotation documents, JSON lines, file listings, archives."""
