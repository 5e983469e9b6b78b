"""DataFrame -> DataFrame operators: decode, triage, classify, analytics."""
