"""Operators of a training-data pipeline: token counts, decontamination, secret
scans, source mixing, toxicity, sharding, quality, line, document and embedding
near duplicates, outlier rules, lexical search, spelling variants. Nothing outside
this folder imports it."""
