"""Training-data operators: language, tokens, urls, pages, packing, de-duplication, quality, shards.

Nothing else in the library imports this subpackage.  Every operator takes a DataFrame,
reads only the columns it names (extra columns, also ones named like its own outputs, are
ignored) and states in its docstring what nulls, empty texts, ties and repeated rows give.
"""
