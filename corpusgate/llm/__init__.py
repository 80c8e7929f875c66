"""Operators for preparing large text collections; nothing outside this folder imports it."""
