"""Nothing streams: every operator of the corpus is a batch over whole tables.

Operators that work row by row (rules.with_classification, rules.with_drop_reason, the functions) take a streaming
DataFrame as it is; corpus-wide ones (duplicates, splits, context) are defined on a whole corpus.
"""
