"""Training-data operators: filtering, dedup, scanning, tokenising and archiving.

One module per operator (``op1_urls`` ... ``op10_ngram_join``), each with a
general interface; ``registry`` holds the thin queries over the given tables
and their SQL.  Nothing outside this subpackage imports it.
"""
