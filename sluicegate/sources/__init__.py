"""Readers, the wire envelope, stored tables and the derived test stream."""
