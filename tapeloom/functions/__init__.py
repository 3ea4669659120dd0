"""Scalar column functions: time texts, number texts, ids, ordering keys."""
