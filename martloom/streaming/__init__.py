"""Micro-batch form of the incremental loads."""
