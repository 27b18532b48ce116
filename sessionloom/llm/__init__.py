"""Preparing training text: filtering, de-duplication, mixing, counting and packing."""
