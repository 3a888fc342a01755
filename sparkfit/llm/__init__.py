"""Training-data operators: token files, language ID, source mixing, near and
exact deduplication, token counts, line deduplication, fingerprints, chat
formatting and byte-level BPE. Nothing else in the library imports this
subpackage; its queries are in ``queries`` and their SQL in ``oracle``."""
