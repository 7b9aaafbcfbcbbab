"""Operators for preparing training text: formatting, scrubbing, deduplication, scoring, decontamination, packing."""
