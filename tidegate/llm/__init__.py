"""Operators for preparing training text: scoring, extraction, scanning, joining, formatting, mixing."""
