"""Spans of kinds in a text, and the strings and digests that name them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence

Span = tuple[str, int, int]  # kind, start, end (exclusive), in code points


def joined(spans: Iterable[Span], kinds: Sequence[str]) -> str:
    """``kind:start:end`` in the order of start and then of ``kinds``, comma-joined."""
    rank = {kind: k for k, kind in enumerate(kinds)}
    ordered = sorted(spans, key=lambda s: (s[1], rank[s[0]], s[2]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in ordered)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Cover:
    """Whether an interval meets any of some spans."""

    def __init__(self, spans: Iterable[Span]):
        self.merged: list[list[int]] = []
        for _, start, end in sorted(spans, key=lambda s: s[1]):
            if self.merged and start <= self.merged[-1][1]:
                self.merged[-1][1] = max(self.merged[-1][1], end)
            else:
                self.merged.append([start, end])
        self.starts = [a for a, _ in self.merged]

    def meets(self, start: int, end: int) -> bool:
        from bisect import bisect_left

        at = bisect_left(self.starts, end) - 1
        return at >= 0 and self.merged[at][1] > start
