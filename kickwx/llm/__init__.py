"""Training-data operators: filters, deduplication, packing, tokenizers, classifiers.

Every operator takes a DataFrame and column names and returns its own columns only, so extra
input columns, whatever their names, are ignored unless an operator's docstring says otherwise.
"""
