"""Training-data operators: language ID, WARC, HTML text, decontamination, mixing,
personal data, token files, near duplicates, exact top-k search, quality, Merkle
manifests, Hilbert shards and tokenizer alignment.

Nothing else in the library imports this subpackage.
"""
