"""Example receivers of update requests, named in the options of the delivery sink."""

from __future__ import annotations


def refuse_250(requests: list[str]) -> list[bool]:
    """Takes every request but the one that ends with 250."""
    return [not r.endswith(" 250") for r in requests]
