"""The queries checked against an independent SQL engine."""
