"""Subpackage of tessella."""
