"""Training-data operators: language, archives, duplicates, toxicity, tokens, packing, search.

Nothing outside this folder imports it.  Every operator takes and returns
DataFrames; ``queries`` holds the thin ``opN_*`` queries over whole tables.
"""
