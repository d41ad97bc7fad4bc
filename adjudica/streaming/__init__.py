"""Micro-batch entry points."""
