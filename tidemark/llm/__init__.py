"""Operators on the text of documents; nothing else in the library imports this subpackage."""
