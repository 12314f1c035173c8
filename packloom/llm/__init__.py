"""Training-data operators: archives, sharding, quality, language, mixing, decontamination, deduplication, token files, URL filters.

Nothing outside this subpackage imports it.
"""
