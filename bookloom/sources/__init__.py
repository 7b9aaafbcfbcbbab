"""Readers. Every reader pins its schema, so nothing is scanned to infer one."""
