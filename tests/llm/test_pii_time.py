"""The search for personal data takes time in proportion to the text, whatever it holds."""

from __future__ import annotations

import random
import re
import time

import pytest

from tidefunnel.llm import pii
from tidefunnel.llm.pii import EACH, Rewritten

SIZE = 1_000_000
RUNS = ["a", "1", "ab.", "ab dot ", "at dot ", " ", "1 ", "a at b ", "1.", "+1 ", "(", "( ", "а", "-", "_", "@", "a@", "one "]


@pytest.mark.parametrize("run", RUNS)
def test_long_runs(run):
    for tail in (" dot", " (at) x"):
        began = time.perf_counter()
        pii.find(run * (SIZE // len(run)) + tail)
        assert time.perf_counter() - began < 20  # seconds; a quadratic search takes hours


def test_base_spans_equal_the_plain_patterns():
    """The patterns as they are stated, on random text."""
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    r = random.Random(5)
    for _ in range(3000):
        text = "".join(r.choice(["a", "b", "1", "22", "333", ".", ".", "@", " ", "-", "+", "(", ")", "4539"]) for _ in range(r.randrange(40)))
        want = [
            (kind, *m.span())
            for kind, p in plain.items()
            for m in re.finditer(p, text)
            if pii._valid(kind, m[0])
        ]
        assert pii.base_spans(text) == want


def test_rewritten_maps_like_lists():
    """Random edits against one source span for each character."""
    r = random.Random(6)
    for _ in range(500):
        text = "".join(r.choice("abcdef ") for _ in range(r.randrange(1, 30)))
        new, spans, plain = Rewritten(text), [(i, i + 1, False) for i in range(len(text))], text
        for how in (EACH, 1, 1):
            edits, at = [], 0
            while at < len(plain):
                a = at + r.randrange(4)
                b = a + r.randrange(1, 4)
                if b > len(plain):
                    break
                put = "X" * (b - a) if how == EACH else r.choice(["", "y", "zzz"])
                edits.append((a, b, put))
                at = b + r.randrange(3)
            out, moved, at = [], "", 0
            for a, b, put in edits:
                out += spans[at:a]
                moved += plain[at:a] + put
                if how == EACH:
                    out += [(x, y, True) for x, y, _ in spans[a:b]]
                else:
                    out += [(spans[a][0], spans[b - 1][1], True)] * len(put)
                at = b
            spans, plain = out + spans[at:], moved + plain[at:]
            new.replace(edits, how)
            assert new.text == plain
            for _ in range(5):
                if plain:
                    a = r.randrange(len(plain))
                    b = r.randrange(a, len(plain)) + 1
                    assert new.source(a, b) == (spans[a][0], spans[b - 1][1])
                    gap = spans[b - 1][1] - spans[a][0] != b - a
                    assert new.touches(a, b) == (gap or any(t for _, _, t in spans[a:b]))
