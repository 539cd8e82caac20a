"""Training-data operators: near-dedup, packing, formatting, fingerprints, archives, PII, decontamination, models.

Nothing outside this subpackage imports it; ``chronomark.llm.registry`` lists its queries.
"""
