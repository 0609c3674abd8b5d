"""Training-data operators: sharding, quality rules, chat formatting, LM
scoring, PII, BPE, mixing, fingerprints, license scans and near duplicates.

Nothing outside this package imports it; ``queries`` registers the dealt
queries, which ``__spark_entry__`` adds when the package can be imported.
"""
