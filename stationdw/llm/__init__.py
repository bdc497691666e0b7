"""Training-data operators: language id, PII surrogates, near and substring dedup, WARC
archives, version fingerprints, source mixing, exact top-k search, BPE and token counts.

Nothing outside this package imports it; it imports only general helpers of the library.
"""
