"""DataFrame operators: harmonise, keyed merges, audits, size-checked broadcast."""
