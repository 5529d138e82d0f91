"""Training-data operators: URL filters, licence scans, SentencePiece coding,
language ID, top-k search, n-gram Jaccard join, quality, mixing, toxicity, Merkle
manifests, substring dedup and periodic runs.

Nothing outside this subpackage imports it.
"""
