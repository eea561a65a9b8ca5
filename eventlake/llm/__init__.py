"""Operators on free text and on entities named by people; nothing outside this subpackage imports it."""
