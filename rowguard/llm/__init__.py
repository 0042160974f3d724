"""Training-data operators: tokenising, filtering and packaging text corpora.

One module per operator, each with a general DataFrame-in, DataFrame-out
interface; ``queries`` binds them to the test tables. Nothing else in the
library imports this subpackage.
"""
