"""Structured Streaming jobs over the batch operators.

State lives in tables in the shared folder, one version per batch, so a batch
that is tried again starts from the version before it.
"""
