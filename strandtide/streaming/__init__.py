"""Structured Streaming forms of the curation and ledger operators."""
