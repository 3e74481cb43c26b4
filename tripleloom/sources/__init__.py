"""Scans of the four dumps. Each gives one DataFrame of records and of errors (:class:`Parsed`)."""

from .scan import SOURCES, Parsed, read_source

__all__ = ["SOURCES", "Parsed", "read_source"]
