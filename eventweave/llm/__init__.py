"""Training-data operators: dedup, mixing, quality, extraction, fingerprints, token files,
sharding, toxicity and packing. Nothing outside this subpackage imports it.

Modules hold one operator each; ``queries`` registers one query per operator and
``textops`` has the vectorised text helpers that run inside Arrow tasks.
"""
