"""Lazy DataFrame -> DataFrame operators."""
