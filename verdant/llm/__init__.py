"""Training-data operators: ten document operators and the corpus pipeline.

Nothing else in the library imports this subpackage.
"""
