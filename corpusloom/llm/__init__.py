"""Training-data operators: decontamination, deduplication, scoring, filtering,
token counting, extraction, mixing, sharding and chat formatting.

Nothing else in the library imports this subpackage; ``queries`` holds its
catalogue entries.
"""
