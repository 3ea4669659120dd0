"""Batch operators over trades and notifications."""
