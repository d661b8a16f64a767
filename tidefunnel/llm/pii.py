"""Personal data in plain and disguised form, with spans in the source text.

Plain (base) matches come from four patterns on the text as it is.  Disguised ones
come from transducers that rewrite a text step by step and keep, for every
character they put out, where in the source it began and ended:

1. characters: look-alike letters and digits become ASCII, invisible ones vanish;
2. words: spelled digits between word edges become digits, and the spaces or
   hyphens between single digits go ("five five-five" -> "555"), where two are
   spelled; and, in a second try, where one is;
3. signs: " at ", "(at)", "[dot]" and their kin become "@" and "."; where the name
   before a plain " at " is prose, the search goes on behind that sign.

The patterns run on the rewritten text too; a match that a rewriting touched is
mapped back to source characters and added unless it overlaps a base match.  Base
matches stay as they are.  Texts without any sign of a disguise skip all of this.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefunnel.llm.common import documents, small_batches

KINDS = ("email", "ip", "card", "phone")

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    # tried at the first digit of a run only: from another one it fails where the first one does
    "ip": r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

# Look-alikes of ASCII letters in Cyrillic and Greek.
LOOK_ALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y",
    "х": "x", "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H",
    "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "І": "I",
    "α": "a", "ε": "e", "ο": "o", "ρ": "p", "ν": "v", "ι": "i",
    "Α": "A", "Β": "B", "Ε": "E", "Η": "H", "Ι": "I", "Κ": "K",
    "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Χ": "X",
    "\u2010": "-", "\u2011": "-", "\u2012": "-", "\u2013": "-", "\u2212": "-",
    "\u2024": ".", "\u3002": ".",
    "\u00a0": " ", "\u2007": " ", "\u2009": " ", "\u202f": " ",
}
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
ENDINGS = (  # of domains, without those that are words of prose ("at", "in", "it", "me")
    "com", "org", "net", "edu", "gov", "mil", "int", "info", "biz", "io", "co", "dev", "app", "ai", "uk", "de",
    "fr", "es", "nl", "ch", "eu", "ca", "au", "nz", "jp", "cn", "br", "ru", "pl", "se", "dk", "fi", "ie", "pt", "cz", "gr",
)
DIGITS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4",
    "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
}


def _by_number(first: int, letters: str) -> dict[str, str]:
    return {chr(first + i): c for i, c in enumerate(letters)}


@lru_cache(maxsize=1)
def characters() -> dict[str, str]:
    """Every rewritten character: the table above and the regular Unicode runs."""
    table = dict(LOOK_ALIKES)
    table |= _by_number(0xFF01, "".join(map(chr, range(0x21, 0x7F))))  # full width
    for first in (0x0660, 0x06F0, 0x0966, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6):
        table |= _by_number(first, "0123456789")
    return table | dict.fromkeys(INVISIBLE, "")


@lru_cache(maxsize=1)
def _compiled() -> dict[str, re.Pattern]:
    word = "|".join(DIGITS)
    at = r"(?:\s*[\[({<]\s*at\s*[\])}>]\s*|\s+at\s+)"
    dot = r"(?:\s*[\[({<]\s*(?:dot|point)\s*[\])}>]\s*|\s+dot\s+)"
    name = r"[A-Za-z0-9_%+-]++"
    part = r"[A-Za-z0-9-]++"
    return {kind: re.compile(p) for kind, p in PATTERNS.items()} | {
        "odd": re.compile("[" + "".join(map(re.escape, characters())) + "]"),
        "looks": re.compile("[" + "".join(re.escape(c) for c, new in characters().items() if new) + "]+"),
        "hidden": re.compile(f"[{INVISIBLE}]+"),
        "digits": re.compile(
            rf"(?<![A-Za-z0-9])(?:{word}|[0-9]+)(?:[\s,-]+(?:{word}|[0-9]+))+(?![A-Za-z0-9])", re.I
        ),
        "digit": re.compile(rf"({word})|([0-9]+)|([\s,-]+)", re.I),
        "spelled": re.compile(rf"(?<![A-Za-z])(?:{word})(?![A-Za-z])", re.I),
        # a disguised address is a chain of names, a sign for "@" and a domain; each sign is
        # found first, then what ends before it and what begins behind it
        "core": re.compile(r"(?P<plain>(?<=\s)at(?=\s))|[\[({<]\s*+at\s*+[\])}>]|@", re.I),
        "chain": re.compile(rf"{name}(?:(?:\.|{dot}){name})*+", re.I),
        "domain": re.compile(rf"{part}(?:(?:\.|{dot}){part})++", re.I),
        "dots": re.compile(rf"(?<![0-9.])[0-9]{{1,3}}(?:(?:\.|{dot})[0-9]{{1,3}}){{3}}(?![0-9])", re.I),
        "sign": re.compile(rf"({at}|\s*@\s*)|({dot})", re.I),
        "bracket": re.compile(r"[\[({<]\s*at\s*[\])}>]", re.I),
        "apart": re.compile(r"@\s|\s@"),
        # a name as only addresses have it, and a domain, around a plain "at"
        "plain": re.compile(
            rf"[a-z][a-z0-9]*(?:[._+][a-z0-9]+)+\s+at\s+(?:[a-z0-9-]+\.)+(?:{'|'.join(ENDINGS)})", re.I
        ),
        "plain sign": re.compile(r"[._+][a-z0-9]+\s+at\s+[a-z0-9-]+\.[a-z]", re.I),
        "dotted": re.compile(r"[\[({<\s](?:dot|point)[\])}>\s]|[\[({<]\s*at\s*[\])}>]", re.I),
    }


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _valid(kind: str, found: str) -> bool:
    if kind == "ip":
        return all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in found.split("."))
    digits = re.sub(r"[^0-9]", "", found)
    if kind == "card":
        return 13 <= len(digits) <= 19 and _luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of plain matches, by kind and start; failing ones are dropped."""
    out = []
    p = _compiled()
    for kind, sign in (("email", "@"), ("ip", "."), ("card", ""), ("phone", "+")):
        if sign not in text:
            continue
        if kind == "email":
            out += _emails(text)
        else:
            out += [(kind, *m.span()) for m in p[kind].finditer(text) if _valid(kind, m[0])]
    return out


LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _emails(text: str) -> list[tuple[str, int, int]]:
    """As the pattern's search, but starting at each "@" (no long runs are tried in vain)."""
    out, free, at = [], 0, text.find("@")
    pattern = _compiled()["email"]
    while at >= 0:
        a = at
        while a > free and text[a - 1] in LOCAL:
            a -= 1
        m = pattern.match(text, a) if a < at else None
        if m:
            out.append(("email", *m.span()))
            free = m.end()
        at = text.find("@", max(free, at + 1))
    return out


KEPT, WHOLE, EACH = 0, 1, 2  # how the characters of a part stand for the source


class Rewritten:
    """A text under rewriting, and where in the source its parts come from.

    ``parts`` holds (place, source start, source end, how) in order of place: a KEPT part
    is a stretch of the source, each character of an EACH part replaces one of the
    source, and every character of a WHOLE part stands for all of its source span.
    Memory follows the edits.
    """

    def __init__(self, text: str):
        self.text, self.parts = text, [(0, 0, len(text), KEPT)]

    @property
    def edited(self) -> bool:
        return len(self.parts) > 1 or self.parts[0][3] != KEPT

    def replace(self, edits: list[tuple[int, int, str]], how: int = WHOLE) -> None:
        """Put strings in the place of spans (in order, apart from each other)."""
        if not edits:
            return
        old, n = self.parts, len(self.text)
        ends = [p[0] for p in old[1:]] + [n]
        text, parts, place, at, k = [], [], 0, 0, 0

        def stretch(upto: int, way: int) -> None:
            """What lies before ``upto`` stays as it was mapped, part by part."""
            nonlocal at, k, place
            while at < upto:
                while ends[k] <= at:
                    k += 1
                out, start, end, was = old[k]
                stop = min(upto, ends[k])
                if was == WHOLE:
                    parts.append((place, start, end, WHOLE))
                else:
                    parts.append((place, start + at - out, start + stop - out, max(was, way)))
                place += stop - at
                at = stop

        for a, b, new in [*edits, (n, n, "")]:
            if at < a:
                text.append(self.text[at:a])
                stretch(a, KEPT)
            if new and how == EACH:
                stretch(b, EACH)
                text.append(new)
            elif new:
                while ends[k] <= a:
                    k += 1
                out, start, _, was = old[k]
                first = start if was == WHOLE else start + a - out
                while ends[k] < b:
                    k += 1
                out, start, end, was = old[k]
                parts.append((place, first, end if was == WHOLE else start + b - out, WHOLE))
                text.append(new)
                place += len(new)
            at = b
        self.text, self.parts = "".join(text), parts or [(0, 0, 0, WHOLE)]

    def _part(self, i: int) -> int:
        return bisect_right(self.parts, i, key=lambda p: p[0]) - 1

    def source(self, a: int, b: int) -> tuple[int, int]:
        first, last = self.parts[self._part(a)], self.parts[self._part(b - 1)]
        return (
            first[1] if first[3] == WHOLE else first[1] + a - first[0],
            last[2] if last[3] == WHOLE else last[1] + b - last[0],
        )

    def touches(self, a: int, b: int) -> bool:
        """Whether a rewriting put, or took away, something in these places."""
        x, y = self.source(a, b)
        return y - x != b - a or any(p[3] for p in self.parts[self._part(a) : self._part(b - 1) + 1])


def _digit_edits(text: str, least: int) -> list[tuple[int, int, str]]:
    """Runs of digits, ``least`` of them spelled out: digits for words, nothing between them."""
    p, out = _compiled(), []
    for run in p["digits"].finditer(text):
        if len(p["spelled"].findall(run[0])) < least:
            continue
        for m in p["digit"].finditer(text, *run.span()):
            if m[1]:
                out.append((*m.span(), DIGITS[m[1].lower()]))
            elif m[3] and m.end() < run.end():
                out.append((*m.span(), ""))
    return out


def _spread(text: str, core: re.Match) -> tuple[int, int]:
    """A sign with the white space around it."""
    a, b = core.span()
    while a and text[a - 1].isspace():
        a -= 1
    while b < len(text) and text[b].isspace():
        b += 1
    return a, b


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """Spans of disguised addresses.

    Plain words around "at" alone are prose; an address has a written dot or bracket,
    or else a name of several parts and a domain ("jo.do at x.org").
    What stands behind the "at" of prose, or between two signs, may be the name of an
    address ("me at jo.do (at) x.org"), so a run of prose takes nothing from the next sign.
    A sign's names begin behind the sign before it, so each stretch is looked at twice.
    """
    p, at = _compiled(), 0
    signs = [(*_spread(text, core), core["plain"]) for core in p["core"].finditer(text)]
    spans = []
    behind = 0
    for a, b, plain in signs:
        chain = None
        for chain in p["chain"].finditer(text, behind, a):
            pass
        domain = p["domain"].match(text, b)
        whole = chain is not None and chain.end() == a and domain
        spans.append((chain.start(), domain.end()) if whole else None)
        behind = b
    for n, ((_, b, plain), span) in enumerate(zip(signs, spans, strict=True)):
        if span is None or span[0] < at:
            continue
        following = spans[n + 1] if n + 1 < len(spans) else None
        named = plain and following and following[0] == b and _disguised(text[slice(*following)])
        if not named and _disguised(text[slice(*span)]):
            yield span
            at = span[1]


def _disguised(run: str) -> bool:
    p = _compiled()
    return "@" in run or bool(p["dotted"].search(run) or p["plain"].fullmatch(run))


def _sign_edits(text: str) -> list[tuple[int, int, str]]:
    p, out = _compiled(), []
    for span in (*_addresses(text), *(run.span() for run in p["dots"].finditer(text))):
        for m in p["sign"].finditer(text, *span):
            new = "@" if m[1] else "."
            if m[0] != new:
                out.append((*m.span(), new))
    return sorted(set(out))


LETTERS = bytes(c if 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
SPELLED = frozenset(w.encode() for w in DIGITS)
SIGNS = frozenset({b"dot", b"point"})


def _suspects(text: str) -> tuple[bool, bool, bool]:
    """Whether look-alikes, spelled digits, or written signs can be in the text at all."""
    p = _compiled()
    odd = False
    if not text.isascii():
        try:  # most western text has none of them
            raw = text.encode("latin-1")
            odd = b"\xad" in raw or b"\xa0" in raw
        except UnicodeEncodeError:
            odd = bool(p["odd"].search(text))
    words = text.encode().translate(LETTERS).split()
    signs = (
        not SIGNS.isdisjoint(words)
        or bool(p["bracket"].search(text))
        or bool(p["apart"].search(text))
        or b"at" in words and bool(p["plain sign"].search(text))
    )
    return odd, not SPELLED.isdisjoint(words), signs


def _rewritings(text: str) -> Iterator[Rewritten]:
    """The text with all disguises undone; and again with single spelled digits undone too.

    One spelled digit beside others may be a digit or a word of prose ("one 4539..."),
    so both are tried.
    """
    odd, spelled, signs = _suspects(text)
    if not (odd or spelled or signs):
        return
    table, before = str.maketrans(characters()), None
    for least in (2, 1):
        new = Rewritten(text)
        if odd:
            found = _compiled()["looks"].finditer(text)
            new.replace([(*m.span(), m[0].translate(table)) for m in found], EACH)
            new.replace([(*m.span(), "") for m in _compiled()["hidden"].finditer(new.text)])
            _, spelled, signs = _suspects(new.text)
        edits = _digit_edits(new.text, least) if spelled else []
        if edits == before:
            return
        before = edits
        new.replace(edits)
        if signs:
            new.replace(_sign_edits(new.text))
        if new.edited:
            yield new
        if not spelled:
            return


def added_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Matches that only show after rewriting, as source spans that no base match overlaps.

    Those of the second rewriting are added where the first found nothing.
    """
    out, known = [], bytearray(len(text))
    for kind, x, y in base:
        known[x:y] = b"\1" * (y - x)
    for new in _rewritings(text):
        more = []
        for kind, a, b in base_spans(new.text):
            if new.touches(a, b):
                x, y = new.source(a, b)
                if known.find(1, x, y) < 0:
                    more.append((kind, x, y))
        for kind, x, y in more:
            known[x:y] = b"\1" * (y - x)
        out += more
    return out


def find(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, all spans), by kind as in KINDS, then start."""
    base = base_spans(text)
    rank = {k: i for i, k in enumerate(KINDS)}
    every = sorted({*base, *added_spans(text, base)}, key=lambda x: (rank[x[0]], x[1], x[2]))
    return base, every


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Each span, overlapping ones together, becomes the name of its kind in brackets."""
    out, at, end, kind = [], 0, -1, ""
    for k, a, b in sorted(spans, key=lambda x: (x[1], -x[2])):
        if a < end:
            end = max(end, b)
            continue
        if end >= 0:
            out.append(f"[{kind.upper()}]")
            at = end
        out.append(text[at:a])
        kind, end = k, b
    if end >= 0:
        out.append(f"[{kind.upper()}]")
        at = end
    return "".join(out) + text[at:]


FOUND = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long,"
    " base_sha256 string, spans string, n_added long"
)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of plain matches by kind, a digest of them, all spans, and how many were added.

    NULL and empty texts have none (the digest is that of the empty string); rows
    that repeat an id stay apart.  Offsets count code points.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        for batch in small_batches(batches):
            rows = [find(t) for t in batch.column("text").to_pylist()]
            counts = [[sum(k == kind for k, _, _ in base) for base, _ in rows] for kind in KINDS]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *(pa.array(c, pa.int64()) for c in counts),
                    pa.array([sha256(joined(base).encode()).hexdigest() for base, _ in rows], pa.string()),
                    pa.array([joined(every) for _, every in rows], pa.string()),
                    pa.array([len(every) - len(base) for base, every in rows], pa.int64()),
                ],
                names=[c.split()[0] for c in FOUND.split(", ")],
            )

    return documents(docs, id_col, text_col).mapInArrow(run, FOUND)


def without_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span, plain or disguised, replaced by the name of its kind.

    Other columns stay as they are; a NULL text stays NULL.
    """

    rows = docs.withColumn(text_col, F.col(text_col).cast("string"))
    place = rows.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = batch.column(place).to_pylist()
            clean = pa.array([t if t is None else redact(t, find(t)[1]) for t in texts], pa.string())
            yield batch.set_column(place, batch.schema.names[place], clean)

    return rows.mapInArrow(run, rows.schema)
