"""Personal data with offset-preserving deobfuscation.

Base matches come from four plain patterns over the text as it is.  Then transducers
rewrite disguises (look-alike characters, spelled digits, "at" and "dot"), each output
character carrying the source span it stands for; the same patterns run on the rewritten
text and their spans are mapped back.  Spans that no base match of the kind covers are
added.  A transducer looks at a text only around what may be a disguise: characters that
have a plain form, spelled digits, signs for "at", chains of numbers.

All patterns are applied in time proportional to the text, also on long runs of digits
or letters: a match starts only where a run does.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rowmill.llm.bpe import few
from rowmill.llm.common import id_text, ship_code, strings

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, str]

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_CHAIN = re.compile(r"[0-9](?<![0-9]{2})[0-9]*+(?:\.[0-9]++){3,}+")
_PART = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_LONG = re.compile(r"[0-9](?:[\x20-]?[0-9]){13,}+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def emails(text: str) -> Iterator[Span]:
    """Found by their @: the longest run of local characters before it, back to the last match."""
    if "@" not in text:
        return
    last = 0
    for m in _DOMAIN.finditer(text):
        a = m.start()
        while a > last and text[a - 1] in _LOCAL:
            a -= 1
        if a < m.start():
            yield a, m.end(), "email"
            last = m.end()


def ips(text: str) -> Iterator[Span]:
    """A run of dotted numbers matches by fours from its start."""
    for m in _CHAIN.finditer(text):
        parts = [(p.start(), p.end()) for p in _PART.finditer(text, m.start(), m.end())]
        for k in range(0, len(parts) - 3, 4):
            if all(len(v := text[a:b].lstrip("0")) < 4 and int(v or "0") <= 255 for a, b in parts[k : k + 4]):
                yield parts[k][0], parts[k + 3][1], "ip"


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def cards(text: str) -> Iterator[Span]:
    """The whole run of digits with single separators counts, so runs under 14 digits are passed over."""
    for m in _LONG.finditer(text):
        digits = re.sub("[^0-9]", "", m[0]) if len(m[0]) < 40 else ""
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield m.start(), m.end(), "card"


def phones(text: str) -> Iterator[Span]:
    if "+" not in text:
        return
    for m in _PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            yield m.start(), m.end(), "phone"


def base(text: str) -> list[Span]:
    """Matches of the four patterns in the text as it is, by start, then kind."""
    found = [*emails(text), *ips(text), *cards(text), *phones(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


# Look-alikes of ASCII characters (fixed values of public confusables lists); full-width forms,
# mathematical letters and the decimal digits of all scripts follow from Unicode's own data.
LOOK_ALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ɡ": "g", "ո": "n", "ս": "u", "օ": "o", "ց": "g",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "У": "Y", "І": "I", "Ј": "J", "Ѕ": "S",
    "α": "a", "ο": "o", "ν": "v", "ρ": "p", "ι": "i", "κ": "k", "υ": "u", "ϲ": "c", "ϳ": "j", "τ": "t", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ı": "i", "ⅼ": "l", "․": ".", "。": ".", "·": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "﹢": "+", " ": " ", " ": " ", " ": " ", " ": " ",
}
INVISIBLE = frozenset("­​‌‍‎‏⁠﻿")
DIGIT_WORDS = {
    **dict(zip("zero one two three four five six seven eight nine".split(), "0123456789")), "oh": "0",
    **dict(zip("null eins zwei drei vier fünf sechs sieben acht neun".split(), "0123456789")),
    **dict(zip("zéro un deux trois quatre cinq six sept huit neuf".split(), "0123456789")),
    **dict(zip("cero uno dos tres cuatro cinco seis siete ocho nueve".split(), "0123456789")),
}
_SPELLED = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
_DIGIT_RUN = re.compile(rf"(?<!\w)(?:(?:plus|\+)[\x20-]*)?(?:(?:{_SPELLED}|[0-9])(?!\w)[\x20.,-]{{0,2}}(?:(?:dot|point|punkt|punto)(?!\w)\x20)?)*(?:{_SPELLED})(?!\w)(?:[\x20.,-]{{0,2}}(?:(?:dot|point|punkt|punto)\x20)?(?:{_SPELLED}|[0-9]+)(?!\w))*", re.I)
_DIGIT_TOKEN = re.compile(rf"(?P<digit>{_SPELLED})|(?P<plus>plus)|(?P<dot>dot|point|punkt|punto)", re.I)
_NUMERIC, _DIGIT_LEFT, _DIGIT_RIGHT = re.compile("[0-9]"), re.compile(r"[0-9][\x20().,-]{0,2}\Z"), re.compile(r"[\x20().,-]{0,2}[0-9]")
_AT = re.compile(r"\s*[\[({<]\s*(?:at|arroba|arobase|ät|@)\s*[\])}>]\s*|\s+(?:at|arroba|arobase)\s+|(?<=[a-z0-9])_at_(?=[a-z0-9])|&#64;|&#x40;|&commat;|%40", re.I)
_DOT = re.compile(r"\s*[\[({<]\s*(?:dot|punkt|point|punto|\.)\s*[\])}>]\s*|\s+(?:dot|punkt|point|punto)\s+|(?<=[a-z0-9])_dot_(?=[a-z0-9])|&#46;|&#x2e;|&period;", re.I)
#: In lower case, all but the white space around it of what _AT matches.
_AT_CORE = re.compile(r"[\[({<]\s*(?:at|arroba|arobase|ät|@)\s*[\])}>]|a(?<=\sa)(?:t|rroba|robase)(?=\s)|_(?<=[a-z0-9]_)at_(?=[a-z0-9])|&(?:#64|#x40|commat);|%40")
_DOT_WORDS, _DOT_NAMES = ("dot", "punkt", "point", "punto"), ("&#46;", "&#x2e;", "&period;")
_SPACES = re.compile(r"\s*")
_PART_DOT = re.compile(rf"(?<=[0-9])(?:{_DOT.pattern})(?=[0-9])", re.I)
_PARTS = re.compile(rf"[0-9](?<![0-9]{{2}})[0-9]*+(?:(?:\.|{_DOT.pattern})[0-9]++){{3,}}+", re.I)
#: Words that follow a plain "at" in sentences.
_NO_SITE = frozenset("the a an this that these those my your our his her their its all any each every first last least most once home work der die das dem den la le les el los las un una une".split())
_WORD_RIGHT = re.compile(r"[A-Za-z0-9-]+")


class Mapped:
    """A rewritten text; character k stands for source[start[k]:end[k]] (without arrays: for itself)."""

    def __init__(self, text: str, start: np.ndarray | None = None, end: np.ndarray | None = None):
        self.text, self.start, self.end = text, start, end

    def rewrite(self, changes: list[tuple[int, int, str]]) -> "Mapped":
        """Replace spans, in order and apart from each other; each new character stands for the whole span."""
        if not changes:
            return self
        out, at = [], 0
        for a, b, new in changes:
            out += [self.text[at:a], new]
            at = b
        a, b, size = (np.array(x) for x in zip(*((a, b, len(new)) for a, b, new in changes)))
        n = len(self.text)
        start = np.arange(n) if self.start is None else self.start
        end = np.arange(1, n + 1) if self.end is None else self.end
        step = np.zeros(n + 1, np.int64)
        np.add.at(step, a, 1)
        np.add.at(step, b, -1)
        kept = np.flatnonzero(np.cumsum(step[:n]) == 0)
        order = np.argsort(np.concatenate([2 * kept + 1, np.repeat(2 * a, size)]), kind="stable")
        return Mapped("".join([*out, self.text[at:]]), np.concatenate([start[kept], np.repeat(start[a], size)])[order], np.concatenate([end[kept], np.repeat(end[b - 1], size)])[order])

    def source(self, a: int, b: int) -> tuple[int, int]:
        return (a, b) if self.start is None else (int(self.start[a]), int(self.end[b - 1]))


@cache
def plain_character(c: str) -> str:
    if c in INVISIBLE:
        return ""
    if c in LOOK_ALIKES:
        return LOOK_ALIKES[c]
    if (d := unicodedata.digit(c, None)) is not None:
        return str(d)
    wide = unicodedata.normalize("NFKC", c)
    return wide if len(wide) == 1 and wide.isascii() else c


def unmask_characters(m: Mapped) -> Mapped:
    if m.text.isascii():
        return m
    odd = [c for c in set(m.text) if ord(c) > 127 and plain_character(c) != c]
    if not odd:
        return m
    return m.rewrite([(x.start(), x.end(), plain_character(x[0])) for x in re.finditer("[" + re.escape("".join(odd)) + "]", m.text)])


def lowered(text: str) -> str:
    """In lower case, of the same length: a dotted capital i becomes an i, as patterns take it."""
    return text.replace("\u0130", "i").lower()


def _spelled_word() -> re.Pattern[str]:
    """A spelled digit, by its first letter: what can't start one is passed over quickly."""
    by_letter: dict[str, list[str]] = {}
    for w in sorted(DIGIT_WORDS, key=len, reverse=True):
        by_letter.setdefault(w[0], []).append(w[1:])
    return re.compile("|".join(rf"{c}(?<!\w\w)(?:{'|'.join(rest)})(?!\w)" for c, rest in by_letter.items()))


_SPELLED_WORD = _spelled_word()


def run_starts(text: str, low: str, at: int, first: int) -> list[int]:
    """Where a run may start whose first spelled digit is at ``first``, ascending: at a plus, at single digits
    before it, or there."""
    starts = [k := first]
    while True:
        i = k
        if text[i - 1 : i] == " ":
            i -= next((len(w) + 1 for w in _DOT_WORDS if low.endswith(w, 0, i - 1)), 0)
        gap = 1 if text[i - 1 : i] in _SEPARATORS and "0" <= text[i - 2 : i - 1] <= "9" else 2
        digit = i - gap - 1
        if digit < at or not all(c in _SEPARATORS for c in text[digit + 1 : i]) or not "0" <= text[digit] <= "9":
            break
        before = text[digit - 1 : digit]
        if before.isalnum() or before == "_":
            break
        starts.append(k := digit)
    i = k
    while i > at and text[i - 1] in " -":
        i -= 1
    starts += [i - len(w) for w in ("+", "plus") if low.endswith(w, at, i)]
    return starts[::-1]


_SEPARATORS = frozenset(" .,-")


def digit_runs(text: str) -> Iterator[re.Match[str]]:
    """What ``_DIGIT_RUN.finditer`` gives; tried only where a spelled digit is near."""
    low, at = lowered(text), 0
    for word in _SPELLED_WORD.finditer(low):
        if word.start() >= at:
            for start in run_starts(text, low, at, word.start()):
                if run := _DIGIT_RUN.match(text, start):
                    yield run
                    at = run.end()
                    break


def unmask_digits(m: Mapped) -> Mapped:
    """Runs with at least four spelled digits, or with digits in or next to them, become digits; single
    blanks and commas inside go.  The detectors decide what is a number."""
    changes = []
    for run in digit_runs(m.text):
        tokens = list(_DIGIT_TOKEN.finditer(m.text, run.start(), run.end()))
        if sum(t["digit"] is not None for t in tokens) < 4 and not (_NUMERIC.search(run[0]) or _DIGIT_LEFT.search(m.text[max(0, run.start() - 3) : run.start()]) or _DIGIT_RIGHT.match(m.text, run.end())):
            continue
        at = run.start()
        for t in tokens:
            if at < t.start():
                changes += gap(m.text, at, t.start())
            changes.append((t.start(), t.end(), DIGIT_WORDS[lowered(t[0])] if t["digit"] else "+" if t["plus"] else "."))
            at = t.end()
        changes += gap(m.text, at, run.end())
    return m.rewrite(changes)


def gap(text: str, a: int, b: int) -> list[tuple[int, int, str]]:
    """What goes between digits: everything but digits, dots, and a plus."""
    return [(k, k + 1, "") for k in range(a, b) if not (text[k].isdigit() or text[k] in ".+")]


class Names:
    """Starts of the names that end at places of a text, asked for in ascending order: a run of local characters is walked once."""

    def __init__(self, text: str):
        self.text, self.lo, self.hi = text, 0, 0

    def start(self, end: int) -> int:
        """Of the longest name that ends there; ``end`` itself without one."""
        k = end
        while k > 0 and self.text[k - 1] in _LOCAL:
            k -= 1
            if self.lo < k < self.hi:
                k = self.lo
        if k < end:
            self.lo, self.hi = k, end
        while k < end and self.text[k] == ".":
            k += 1
        return k


def back_over_spaces(text: str, at: int, least: int = 0) -> int:
    while at > least and text[at - 1].isspace():
        at -= 1
    return at


def dot_before(text: str, low: str, end: int) -> int | None:
    """Start of a disguised dot that ends there, with the white space around it."""
    k = back_over_spaces(text, end)
    if text[k - 1 : k] in _CLOSE and k:
        inner = back_over_spaces(text, k - 1)
        for w in (*_DOT_WORDS, "."):
            if low.endswith(w, 0, inner):
                open_at = back_over_spaces(text, inner - len(w))
                if open_at and text[open_at - 1] in _OPEN:
                    return back_over_spaces(text, open_at - 1)
    if k < end:
        for w in _DOT_WORDS:
            if low.endswith(w, 0, k) and (i := back_over_spaces(text, k - len(w))) < k - len(w):
                return i
    return next((end - len(w) for w in _DOT_NAMES if k == end and low.endswith(w, 0, end)), None)


_OPEN, _CLOSE = frozenset("[({<"), frozenset("])}>")


def at_signs(text: str, low: str) -> Iterator[tuple[int, int, bool]]:
    """(start, end, bare) of what _AT matches anywhere; bare: just a word."""
    for core in _AT_CORE.finditer(low):
        a, b, bare = core.start(), core.end(), core[0].isalpha()
        if bare or core[0][0] in _OPEN:
            a, b = back_over_spaces(text, a), _SPACES.match(text, b).end()
        yield a, b, bare


def unmask_addresses(m: Mapped) -> Mapped:
    """Disguised "at" and "dot" where they make up an address: name, at, then labels joined by dots,
    at least one of the signs disguised."""
    text = m.text
    low = lowered(text)
    names = Names(text)
    changes: list[tuple[int, int, str]] = []
    at = 0
    for a, found_end, bare in at_signs(text, low):  # bare: " at " alone is a common word
        core = a
        if a < at:  # white space before it belongs to what was found last
            core = _SPACES.match(text, a).end()
            if core < at or (bare and core == at):
                continue
            a = at
        at = found_end
        # the name itself may have dots in disguise: "first dot last at ..."
        begin = names.start(a)
        name = begin < a
        here = [(a, found_end, "@")]
        k, dots = found_end, 0
        spelled = 0
        label = _WORD_RIGHT.match(text, k)
        while label:
            k = label.end()
            sign = _DOT.match(text, k)
            if sign and _WORD_RIGHT.match(text, sign.end()):
                here.append((k, sign.end(), "."))
                spelled += 1
                k = sign.end()
            elif text[k : k + 1] == "." and _WORD_RIGHT.match(text, k + 1):
                k += 1
            else:
                break
            dots += 1
            label = _WORD_RIGHT.match(text, k)
        last = label[0] if label else ""
        site = _WORD_RIGHT.match(text, found_end)
        if name and dots and last.isalpha() and 2 <= len(last) <= 24 and (not bare or (spelled and site[0].lower() not in _NO_SITE)):
            before = []
            while (start := dot_before(text, low, begin)) is not None and (more := Names(text).start(start)) < start:
                before.append((start, begin, "."))
                begin = more
            changes += sorted(before) + here
            at = k
    # an @ as it is, with disguised dots after it
    for sign in re.finditer("@", text):
        k, here = sign.end(), []
        while label := _WORD_RIGHT.match(text, k):
            k = label.end()
            dot = _DOT.match(text, k)
            if dot and _WORD_RIGHT.match(text, dot.end()) and not (dot[0].strip().isalpha() and not _tail(text, dot.end())):
                here.append((k, dot.end(), "."))
                k = dot.end()
            elif text[k : k + 1] == ".":
                k += 1
            else:
                break
        changes += here
    changes.sort()
    apart, end = [], 0
    for c in changes:
        if c[0] >= end and c[1] > c[0]:
            apart.append(c)
            end = c[1]
    return m.rewrite(apart)


def unmask_parts(m: Mapped) -> Mapped:
    """Disguised dots in chains of four or more numbers."""
    return m.rewrite([(d.start(), d.end(), ".") for chain in _PARTS.finditer(m.text) for d in _PART_DOT.finditer(m.text, chain.start(), chain.end())])


def _tail(text: str, at: int) -> bool:
    label = _WORD_RIGHT.match(text, at)
    return bool(label) and label[0].isalpha() and 2 <= len(label[0]) <= 24


def bare_numbers(m: Mapped, source: str) -> Iterator[Span]:
    """Spelled numbers of a phone's length without a plus."""
    for run in re.finditer(r"(?<![0-9+.])[0-9]{10,15}(?![0-9.])", m.text):
        a, b = m.source(run.start(), run.end())
        if sum(c.isalpha() for c in source[a:b]) >= 12:
            yield run.start(), run.end(), "phone"


def undisguised(text: str) -> Mapped:
    """The text without disguises."""
    return unmask_parts(unmask_addresses(unmask_digits(unmask_characters(Mapped(text)))))


def disguised(text: str) -> bool:
    """Whether a transducer rewrites anything."""
    return undisguised(text).text != text


def find(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans, by start, then kind; code points, end exclusive."""
    own = base(text)
    m = undisguised(text)
    if m.text == text:
        return own, own
    covers: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    for a, b, kind in own:
        covers[kind].append((a, b))
    extra = set()
    for a, b, kind in [*base(m.text), *bare_numbers(m, text)]:
        x, y = m.source(a, b)
        at = bisect_left(covers[kind], (x + 1, 0)) - 1  # the last base match that starts at x or before
        if at < 0 or covers[kind][at][1] < y:
            extra.add((x, y, kind))
    return own, sorted({*own, *extra}, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def said(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Personal data of every whole text.

    Input: ``doc_id``, ``text`` (null: empty).  Output, one row per input row: ``doc_id``; ``n_email``,
    ``n_ip``, ``n_card``, ``n_phone``, the numbers of base matches; ``base_sha256``, of the base spans
    as ``kind:start:end``, comma-joined; ``spans``, all spans written likewise.  Repeated rows and
    null ids are treated like any; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few(batches):
            found = [find(t) for t in strings(batch.column("text"))]
            numbers = [pa.array([sum(s[2] == kind for s in own) for own, _ in found], pa.int64()) for kind in KINDS]
            sha = pa.array([hashlib.sha256(said(own).encode()).hexdigest() for own, _ in found], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *numbers, sha, pa.array([said(every) for _, every in found], pa.string())], ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return id_text(docs).mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redacted(text: str) -> str:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first, longest."""
    spans = find(text)[1]
    if not spans:
        return text
    out, at = [], 0
    for a, b, kind in sorted(spans, key=lambda s: (s[0], -s[1])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
            at = b
        elif b > at:  # sticks out of the one before
            at = b
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced (null stays null); all columns and rows are kept."""
    ship_code(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few(batches):
            at = batch.schema.get_field_index("text")
            new = pa.array([None if t is None else redacted(t) for t in batch.column("text").to_pylist()], pa.string())
            yield batch.set_column(at, pa.field("text", pa.string()), new)

    return docs.mapInArrow(run, docs.schema)
