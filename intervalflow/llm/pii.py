"""Format-preserving pseudonyms for personal data.

Validated values are found in whole texts and replaced by a keyed permutation within their own format, so equal values get equal
pseudonyms in every document, different values different ones, and the text keeps its shape.  The permutation is a Feistel
network over the values of the format: the value's characters are read as one number in a mixed radix (10 for digits, 26 for
letters, or a date's day number), the halves of its bits are mixed by keyed rounds, and numbers beyond the format walk on until
they fall inside, which keeps the map one to one.  With the key the values can be restored.

Formats and their checks:

* e-mail addresses: the local part and every domain label but the last, letter for letter, digit for digit; names that differ in case stay apart
* telephone numbers with a country code, or in North American form: every digit behind the country code
* IPv4 addresses with four octets of at most 255: permuted as one 32-bit number
* payment card numbers, 13 to 19 digits with a right Luhn digit: all digits but the check digit, which is computed anew
* IBANs with right check digits: the characters of the account part, with new check digits
* US social security numbers in a valid area and group: permuted over the valid numbers' digits
* dates written year-month-day or day.month.year that exist, from 1900 to 2099: permuted over those days
* quoted secrets that follow a name such as token, password or api_key: hexadecimal digits stay such, other characters keep their class

Numbers that fail their check are left alone, so ordinary numbers of the same length survive.  Where a match fails because other characters
stand beside the value, its parts are tried: spans of whole digit groups for cards, the country's own length and shorter ends for IBANs, fewer
groups for telephone numbers, later starts for both.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as tx

ROUNDS = 10
KEY = b"intervalflow"       # a deployment passes its own
_FIRST_DAY, _DAYS = dt.date(1900, 1, 1).toordinal(), dt.date(2100, 1, 1).toordinal() - dt.date(1900, 1, 1).toordinal()


class Feistel:
    """A keyed permutation of range(n) for any n."""

    def __init__(self, key: bytes, kind: str, n: int) -> None:
        self.n = n
        self.half = max(1, ((n - 1).bit_length() + 1) // 2)
        self.low = (1 << self.half) - 1
        self.key = hashlib.blake2b(key, digest_size=32, person=b"pii", salt=hashlib.blake2b(f"{kind}:{n}".encode(), digest_size=16).digest()).digest()

    def _round(self, i: int, x: int) -> int:
        d = hashlib.blake2b(x.to_bytes((self.half + 7) // 8, "big"), key=self.key, digest_size=min(64, (self.half + 7) // 8 + 8), salt=bytes([i])).digest()
        return int.from_bytes(d, "big") & self.low

    def _once(self, x: int, rounds) -> int:
        a, b = x >> self.half, x & self.low
        for i in rounds:
            a, b = b, a ^ self._round(i, b)
        return a << self.half | b

    def __call__(self, x: int) -> int:
        """The image of x.  As with any permutation, about one value of each format is its own image."""
        while True:
            x = self._once(x, range(ROUNDS))
            if x < self.n:
                return x

    def invert(self, y: int) -> int:
        while True:
            a, b = y & self.low, y >> self.half                 # the same network with swapped halves and rounds in reverse
            swapped = self._once(a << self.half | b, range(ROUNDS - 1, -1, -1))
            y = (swapped & self.low) << self.half | swapped >> self.half
            if y < self.n:
                return y


DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
HEX_LOWER, HEX_UPPER = DIGITS + "abcdef", DIGITS + "ABCDEF"


def _alphabet(c: str) -> str | None:
    return DIGITS if c in DIGITS else LOWER if c in LOWER else UPPER if c in UPPER else None


class Pseudonyms:
    """All formats under one key.  ``back`` restores instead."""

    def __init__(self, key: bytes = KEY, back: bool = False) -> None:
        self.key, self.back, self.nets = key, back, {}

    def permute(self, kind: str, x: int, n: int) -> int:
        net = self.nets.get((kind, n))
        if net is None:
            net = self.nets[kind, n] = Feistel(self.key, kind, n)
        return net.invert(x) if self.back else net(x)

    def characters(self, kind: str, text: str, alphabet: Callable[[str], str | None] = _alphabet) -> str:
        """Every character of an alphabet is permuted within it, all together as one number; the others stay."""
        sets = [alphabet(c) for c in text]
        x, n = 0, 1
        for c, s in zip(text, sets):
            if s:
                x, n = x * len(s) + s.index(c), n * len(s)
        x = self.permute(kind + ":" + "".join(str(len(s)) if s else "-" for s in sets), x, n)
        out = []
        for c, s in zip(reversed(text), reversed(sets)):
            if s:
                x, d = divmod(x, len(s))
                c = s[d]
            out.append(c)
        return "".join(reversed(out))

    # -- formats: each gets a match and returns its replacement, or None where the value is not valid

    def email(self, m) -> str | None:
        local, domain = m.group().rsplit("@", 1)
        names, top = domain.rsplit(".", 1)
        return self.characters("email", f"{local}@{names}") + "." + top

    def phone(self, m) -> str | None:
        n = sum(c in DIGITS for c in m.group())
        if not 10 <= n <= 15:
            return None             # its shorter ends are tried by ``phones``
        head = m.group("one") or m.group("country") or ""
        return head + self.characters("phone", m.group()[len(head):], lambda c: DIGITS if c in DIGITS else None)

    def ipv4(self, m) -> str | None:
        parts = m.group().split(".")
        if any(int(p) > 255 or len(p) > 1 and p[0] == "0" for p in parts):
            return None
        x = self.permute("ipv4", int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32)
        return ".".join(map(str, x.to_bytes(4, "big")))

    def card(self, text: str) -> str | None:
        digits = [c for c in text if c in DIGITS]
        if not 13 <= len(digits) <= 19 or luhn(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
            return None
        body = self.characters("card", "".join(digits[:-1]))
        fresh = iter(body + luhn(list(body)))
        return "".join(next(fresh) if c in DIGITS else c for c in text)

    def iban(self, text: str) -> str | None:
        plain = text.replace(" ", "")
        if not 15 <= len(plain) <= 34 or _iban_rest(plain) != 1:
            return None
        body = self.characters("iban", plain[4:])
        check = f"{98 - _iban_rest(plain[:2] + '00' + body):02d}"
        fresh = iter(plain[:2] + check + body)
        return "".join(c if c == " " else next(fresh) for c in text)

    # -- what a match holds: each gets the text and a match, and returns [(start, end, replacement)], without overlaps

    def cards(self, text: str, m) -> list[tuple[int, int, str]]:
        """Of a run of digit groups the whole, else spans of groups: first those in a card's shape, then others of one separator."""
        new = self.card(m.group())
        if new is not None:
            return [(*m.span(), new)]
        groups = [g.span() for g in _DIGITS.finditer(text, *m.span())]
        out, used = [], set()
        for shaped in (True, False):
            if not shaped and text[:m.start()][-1:] == "+":
                break               # a telephone number
            for i in range(len(groups)):
                spans, n = [], 0
                for j in range(i, len(groups)):
                    n += groups[j][1] - groups[j][0]
                    if n > 19 or j in used:
                        break
                    if n >= 13:
                        spans.append((j, n))
                for j, n in reversed(spans):
                    sizes = tuple(b - a for a, b in groups[i:j + 1])
                    if shaped != (len(sizes) == 1 or sizes in CARD_SHAPES):
                        continue
                    if not shaped and (min(sizes) < 2 or 3 * len(sizes) > n or len({text[a - 1] for a, _ in groups[i + 1:j + 1]}) > 1):
                        continue    # a list of small numbers, or two numbers
                    new = self.card(text[groups[i][0]:groups[j][1]])
                    if new is not None:
                        out.append((groups[i][0], groups[j][1], new))
                        used.update(range(i, j + 1))
                        break
        return sorted(out)

    def ibans(self, text: str, m, own: bool) -> list[tuple[int, int, str]]:
        """The country's ``own`` length, or the longest that has right check digits; spaces stand between groups of four."""
        ends, n = {}, 0
        for i in range(*m.span()):
            if text[i] == " ":
                if n % 4:
                    break
                continue
            n += 1
            if n >= 15 and not (text[i + 1:i + 2].isascii() and text[i + 1:i + 2].isalnum()):
                ends[n] = i + 1
        known = IBAN_LENGTHS.get(m.group()[:2])
        for n in [n for n in sorted(ends, reverse=True) if not own or n == known]:
            new = self.iban(text[m.start():ends[n]])
            if new is not None:
                return [(m.start(), ends[n], new)]
        return []

    def phones(self, text: str, m) -> list[tuple[int, int, str]]:
        """The whole match, else as many of its digit groups as a number may have."""
        pattern, stops = m.re, [g.end() for g in _DIGITS.finditer(text, *m.span())]
        for stop in reversed(stops):
            part = m if stop == m.end() else pattern.match(text, m.start(), stop)
            new = self.phone(part) if part and part.end() == stop else None
            if new is not None:
                return [(m.start(), stop, new)]
        return []

    def ssn(self, m) -> str | None:
        area, group, serial = map(int, m.group().split("-"))
        if area in (0, 666) or area >= 900 or not group or not serial:
            return None
        areas = [a for a in range(1, 900) if a != 666]
        x = self.permute("ssn", (areas.index(area) * 99 + group - 1) * 9999 + serial - 1, len(areas) * 99 * 9999)
        x, serial = divmod(x, 9999)
        area, group = divmod(x, 99)
        return f"{areas[area]:03d}-{group + 1:02d}-{serial + 1:04d}"

    def date(self, m) -> str | None:
        sep = m.group("sep1") or m.group("sep2")
        year, month, day = (int(x) for x in (m.group("y", "m", "d") if m.group("y") else m.group("y2", "m2", "d2")))
        try:
            at = dt.date(year, month, day).toordinal() - _FIRST_DAY
        except ValueError:
            return None
        if not 0 <= at < _DAYS:
            return None
        new = dt.date.fromordinal(self.permute("date", at, _DAYS) + _FIRST_DAY)
        return f"{new.year:04d}{sep}{new.month:02d}{sep}{new.day:02d}" if m.group("y") else f"{new.day:02d}{sep}{new.month:02d}{sep}{new.year:04d}"

    def secret(self, m) -> str | None:
        value = m.group("value")
        if all(c in HEX_LOWER for c in value):
            return self.characters("hex", value, lambda c: HEX_LOWER)
        if all(c in HEX_UPPER for c in value):
            return self.characters("hex", value, lambda c: HEX_UPPER)
        return self.characters("secret", value)


_DIGITS = regex.compile("[0-9]+")
#: Digit groups in which cards are written.
CARD_SHAPES = {(4, 4, 4, 4), (4, 4, 4, 4, 3), (4, 6, 5), (4, 6, 4)}
#: Characters of a country's IBANs.
IBAN_LENGTHS = {c: n for n, cs in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC",
    33: "RU"}.items() for c in cs.split()}


def luhn(digits: list[str]) -> str:
    """The check digit behind ``digits``."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 if i % 2 else 2)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _iban_rest(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


#: (format, pattern).  In this order; a replaced range is not looked at again.
PATTERNS = (
    ("secret", r"""(?i:token|secret|password|passwd|api[_-]?key)\s*[=:]\s*(["'])(?P<value>[A-Za-z0-9+/_=-]{16,512})\1"""),
    ("email", r"(?<![A-Za-z0-9])[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,62}[A-Za-z0-9_%+-])?@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.){1,8}"
              r"[A-Za-z]{2,24}(?![A-Za-z0-9]|@[A-Za-z0-9])"),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}"),
    ("ipv4", r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])"),
    ("date", r"(?<![0-9./-])(?:(?P<y>[0-9]{4})(?P<sep1>[-/])(?P<m>[0-9]{2})(?P=sep1)(?P<d>[0-9]{2})"
             r"|(?P<d2>[0-9]{2})(?P<sep2>[./-])(?P<m2>[0-9]{2})(?P=sep2)(?P<y2>[0-9]{4}))(?![0-9]|[./-][0-9])"),
    ("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    ("card", r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,}"),
    ("phone", r"(?<![0-9+])(?:(?P<one>\+1)[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}|(?P<country>\+[0-9]{1,3})[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}"
              r"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9])"),
)


def replacer(key: bytes = KEY, back: bool = False):
    """A function from a text to (new text, [(format, start, end in the new text)])."""
    formats = Pseudonyms(key, back)
    # IBANs of their country's length come first, so that a code in front of one does not claim its start.
    parts_of = {"card": [formats.cards], "phone": [formats.phones], "iban": [partial(formats.ibans, own=True), partial(formats.ibans, own=False)]}
    compiled = [(n, regex.compile(p), getattr(formats, n), f) for n, p in PATTERNS for f in parts_of.get(n, [None])]
    digit = regex.compile("[0-9]")

    def replace(text: str) -> tuple[str, list[tuple[str, int, int]]]:
        # What a format cannot do without; most texts have none of it.
        quoted, at_sign, number = '"' in text or "'" in text, "@" in text, digit.search(text) is not None
        if not (quoted or at_sign or number):
            return text, []
        found: list[tuple[int, int, str, str]] = []
        rest = text         # what no format has claimed; claimed ranges are blanked, so that no later match reaches into them
        for name, pattern, change, parts_in in compiled:
            if not {"secret": quoted, "email": at_sign}.get(name, number):
                continue
            mine, pos = [], 0
            while (m := pattern.search(rest, pos)) is not None:
                pos = m.end()
                if parts_in:
                    parts = parts_in(rest, m)
                    mine += [(a, b, name, new) for a, b, new in parts]
                    if name != "card":
                        pos = parts[-1][1] if parts else m.start() + 1
                else:
                    new = change(m)
                    if new is not None:
                        mine.append((*(m.span("value") if name == "secret" else m.span()), name, new))
            if mine:
                parts, at = [], 0
                for a, b, *_ in mine:
                    parts += [rest[at:a], "\0" * (b - a)]
                    at = b
                rest = "".join([*parts, rest[at:]])
                found += mine
        out, spans, at, size = [], [], 0, 0
        for a, b, name, new in sorted(found):
            out += [text[at:a], new]
            size += a - at
            spans.append((name, size, size + len(new)))
            size, at = size + len(new), b
        return "".join([*out, text[at:]]), spans

    return replace


def pseudonymise(docs: DataFrame, text_col: str = "text", key: bytes = KEY, back: bool = False, spans_col: str | None = None) -> DataFrame:
    """``docs`` with the personal data in ``text_col`` replaced; all other columns stay.  Null and empty texts stay.

    ``spans_col`` adds an array of ``(kind, start, stop)`` in code points of the new text.  The key goes to the executors with the task.
    ``back`` restores what was replaced under the same key (texts in which a pseudonym happens to look like another format excepted)."""
    src = docs.drop(spans_col) if spans_col else docs
    src = src.withColumn(text_col, F.col(text_col).cast("string"))
    cols, at = src.columns, src.columns.index(text_col)
    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))
    schema = ", ".join([f"`{c}` {t}" for c, t in src.dtypes]
                       + ([f"`{spans_col}` array<struct<kind: string, start: int, stop: int>>"] if spans_col else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replace = replacer(key, back)
        for batch in batches:
            for part in tx.slices(batch, text_col):
                done = [replace(t) if t else (t, []) for t in part.column(at).to_pylist()]
                arrays = list(part.columns)
                arrays[at] = pa.array([t for t, _ in done], part.schema.field(at).type)
                if spans_col:
                    arrays.append(pa.array([[{"kind": k, "start": a, "stop": b} for k, a, b in s] for _, s in done], spans))
                yield pa.RecordBatch.from_arrays(arrays, [*cols, *([spans_col] if spans_col else [])])

    return src.mapInArrow(run, schema)
