"""Operators that prepare training text at corpus scale: filters, deduplication, mixing, packing, sharding."""
