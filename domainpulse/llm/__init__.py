"""Training-data operators: sharding, token files, dedup, tokenising, licence scans, toxicity, mixing.

Nothing else in the library imports this subpackage.
"""
