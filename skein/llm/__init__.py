"""Training-data operators: dedup, decontamination, classifiers, language
model scores, sharding, tokenising and web-archive derivatives.

Nothing outside this subpackage imports it.
"""
