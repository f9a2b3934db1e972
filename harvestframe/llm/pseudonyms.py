"""Format-preserving pseudonyms for personal data.

Card numbers, IBANs, social security numbers, phone numbers, IP addresses, dates and e-mail names
are found by pattern, validated (check digits, ranges, the calendar), and replaced by another valid
value of the same format. A value is a number below the size of its format; a keyed Feistel network
with cycle walking permutes these numbers, so equal values get equal pseudonyms in all documents,
different ones stay different, and the holder of the key can restore them.

The permutation is x -> E'(E(x) + 1), E the network and E' its inverse: no value maps to itself.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from datetime import date
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import read_table, small_batches

KEY = b"replace this key"
ROUNDS = 8
KINDS = ("email", "iban", "card", "ssn", "phone", "ip", "date")

_PATTERN = re.compile(
    r"(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9]))"
    r"|(?P<card>(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?P<gap>[ -])[0-9]{4}(?P=gap)[0-9]{4}(?P=gap)[0-9]{4}|[0-9]{4}(?P<gap5>[ -])[0-9]{6}(?P=gap5)[0-9]{5})(?![0-9]))"
    r"|(?P<ssn>(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-]))"
    r"|(?P<phone>(?<![0-9])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ .-]?|(?:(?<=[0-9][ .-])|(?<![0-9.-]))[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
    r"|(?<![\w+])\+[1-9](?:[0-9]{7,14}(?![0-9])|[0-9]{0,2}(?P<step>[ .-])[0-9]{1,4}(?:(?P=step)[0-9]{2,4}(?![0-9/:]|(?!(?P=step))[.-][0-9])){2,4})"
    r"|(?<![\w.,/#=+-])[2-9][0-9]{9}(?![\w/]|[.,-][0-9]))"
    r"|(?P<ip>(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9]))"
    r"|(?P<date>(?<![0-9/.-])(?:[0-9]{4}(?P<d1>[-/.])[0-9]{1,2}(?P=d1)[0-9]{1,2}|[0-9]{1,2}(?P<d2>[-/.])[0-9]{1,2}(?P=d2)[0-9]{4})(?![0-9]))")
_EMAIL = re.compile(r"(?<![\w.%+-])[\w.%+-]+(?=@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})")
#: Characters of an IBAN by country, to tell where one in groups ends.
_IBAN_LENGTH = {c: n for n, cs in {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS", 23: "AE GI IL IQ", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "PT ST",
    26: "IS TR", 27: "FR GR IT MC SM", 28: "AL AZ CY DO GT HU LB PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC"}.items() for c in cs.split()}
#: Country codes of two digits; 1 and 7 have one, others three.
_TWO_DIGITS = set("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
_FIRST_DAY, _LAST_DAY = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()
_ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
              "".join(map(chr, (*range(0xE0, 0xF7), *range(0xF8, 0x100)))), "".join(map(chr, (*range(0xC0, 0xD7), *range(0xD8, 0xDF)))))
_PLACE = {c: (a, i) for a in _ALPHABETS for i, c in enumerate(a)}


class Permutation:
    """Keyed permutations of the numbers below any size; ``tweak`` names the format."""

    def __init__(self, key: bytes, forward: bool = True) -> None:
        self.key, self.turn = key, 1 if forward else -1

    def _round(self, nth: int, tweak: bytes, value: int, bits: int) -> int:
        data = b"%d|%s|%x" % (nth, tweak, value)
        need, out, block = (bits + 7) // 8, b"", 0
        while len(out) < need:
            out += blake2b(data + b"|%d" % block, key=self.key, digest_size=32).digest()
            block += 1
        return int.from_bytes(out[:need], "big") & ((1 << bits) - 1)

    def _network(self, x: int, half: int, tweak: bytes, back: bool) -> int:
        left, right = x >> half, x & ((1 << half) - 1)
        for nth in range(ROUNDS):
            if back:
                left, right = right ^ self._round(ROUNDS - 1 - nth, tweak, left, half), left
            else:
                left, right = right, left ^ self._round(nth, tweak, right, half)
        return left << half | right

    def _walk(self, x: int, size: int, tweak: bytes, back: bool) -> int:
        half = max(1, (size.bit_length() + 1) // 2)
        x = self._network(x, half, tweak, back)
        while x >= size:
            x = self._network(x, half, tweak, back)
        return x

    def __call__(self, x: int, size: int, tweak: str, valid: Callable[[int], bool] = lambda _: True) -> int:
        """Where ``x`` goes among the valid numbers below ``size``."""
        name = f"{tweak}|{size}".encode()
        while True:
            x = self._walk((self._walk(x, size, name, False) + self.turn) % size, size, name, True)
            if valid(x):
                return x


def _luhn(digits: str) -> int:
    """The check digit that the digits before it ask for."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 - i % 2)
        total += d - 9 * (d > 9)
    return -total % 10


def _refill(pattern: str, characters: str) -> str:
    """``pattern`` with its letters and digits, one after the other, from ``characters``."""
    it = iter(characters)
    return "".join(next(it) if c.isalnum() else c for c in pattern)


def _by_alphabet(text: str, permute: Permutation, tweak: str) -> str:
    """Each letter or digit replaced within its alphabet, all of them as one mixed-radix number."""
    places = [_PLACE.get(c) for c in text]
    x, size = 0, 1
    for p in places:
        if p:
            x, size = x * len(p[0]) + p[1], size * len(p[0])
    if size < 2:
        return text
    x = permute(x, size, f"{tweak}|{''.join(p[0][0] if p else c for p, c in zip(places, text))}")
    out = []
    for p, c in zip(reversed(places), reversed(text)):
        if p:
            x, i = divmod(x, len(p[0]))
            c = p[0][i]
        out.append(c)
    return "".join(reversed(out))


def _card(text: str, permute: Permutation) -> str | None:
    digits = re.sub("[ -]", "", text)
    if _luhn(digits[:-1]) != int(digits[-1]) or len(set(digits)) == 1:
        return None
    n = len(digits) - 1
    same = lambda x: len(set(f"{x:0{n}d}{_luhn(f'{x:0{n}d}')}")) > 1
    head = f"{permute(int(digits[:-1]), 10**n, 'card', same):0{n}d}"
    return _refill(text, head + str(_luhn(head)))


def _iban_check(country: str, rest: str) -> int:
    return 98 - int("".join(str(int(c, 36)) for c in rest + country + "00")) % 97


def _iban_valid(text: str) -> bool:
    characters = text.replace(" ", "")
    return int(characters[2:4]) == _iban_check(characters[:2], characters[4:])


def _iban(text: str, permute: Permutation) -> str | None:
    if not _iban_valid(text):
        return None
    characters = text.replace(" ", "")
    country, rest = characters[:2], _by_alphabet(characters[4:], permute, f"iban {characters[:2]}")
    return _refill(text, f"{country}{_iban_check(country, rest):02d}{rest}")


def _iban_end(text: str) -> int | None:
    """Where a valid IBAN in groups ends that ``text`` begins with; words may follow it."""
    left = _IBAN_LENGTH.get(text[:2], len(text) - text.count(" "))
    for end, c in enumerate(text, 1):
        left -= c != " "
        if not left:
            return end if text[end:end + 1] in ("", " ") and _iban_valid(text[:end]) else None
    return None


def _ssn_valid(x: int) -> bool:
    area, group, serial = x // 10**6, x // 10**4 % 100, x % 10**4
    return 0 < area < 900 and area != 666 and group > 0 and serial > 0


def _ssn(text: str, permute: Permutation) -> str | None:
    x = int(text.replace("-", ""))
    return _refill(text, f"{permute(x, 10**9, 'ssn', _ssn_valid):09d}") if _ssn_valid(x) else None


def _phone(text: str, permute: Permutation) -> str | None:
    """The digits after the country code move, among those that a plain number can begin with or the others.

    Without a country code, and with that of North America, the last ten move.
    """
    digits = re.sub("[^0-9]", "", text)
    code = len(digits) - 10 if text[0] != "+" else 1 if digits[0] in "17" else 2 if digits[:2] in _TWO_DIGITS else 3
    n = len(digits) - code
    plain = int(digits[code]) >= 2
    tweak = "" if digits[:code] == "1" else digits[:code]
    return _refill(text, digits[:code] + f"{permute(int(digits[code:]), 10**n, f'phone {tweak}', lambda x: (x // 10**(n - 1) >= 2) == plain):0{n}d}")


def _ip(text: str, permute: Permutation) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or str(int(p)) != p for p in parts):
        return None
    x = permute(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, "ip")
    return ".".join(map(str, x.to_bytes(4, "big")))


def _date_class(day: date) -> tuple[int, bool]:
    """Dates move within a class: of day or month with one digit, and of days that are no months, so that any spelling holds them."""
    return (day.day > 9) + (day.day > 12), day.month > 9


def _date(text: str, permute: Permutation) -> str | None:
    """Year first, or else day first where that is a date, or else month first."""
    parts = re.split("([-/.])", text)
    numbers, gap = parts[::2], parts[1]
    orders = ("ymd",) if len(numbers[0]) == 4 else ("dmy", "mdy")
    for order in orders:
        try:
            day = date(*(int(numbers[order.index(c)]) for c in "ymd"))
        except ValueError:
            continue
        if not _FIRST_DAY <= day.toordinal() <= _LAST_DAY:
            return None
        valid = lambda x: _date_class(date.fromordinal(x + _FIRST_DAY)) == _date_class(day)  # noqa: B023, E731
        new = date.fromordinal(permute(day.toordinal() - _FIRST_DAY, _LAST_DAY - _FIRST_DAY + 1, "date", valid) + _FIRST_DAY)
        return gap.join(f"{ {'y': new.year, 'm': new.month, 'd': new.day}[c]:0{len(n)}d}" for c, n in zip(order, numbers))
    return None


_MAKERS = {"iban": _iban, "card": _card, "ssn": _ssn, "phone": _phone, "ip": _ip, "date": _date,
           "email": lambda text, permute: _by_alphabet(text, permute, "email")}


def _matches(text: str) -> Iterator[tuple[int, int, str]]:
    at = 0
    while m := _PATTERN.search(text, at):
        start, at = m.span()
        if m.group("iban") and " " in m.group():
            if (end := _iban_end(m.group())) is None:
                at = start + 4  # a card can follow
                continue
            at = start + end
        yield start, at, m.lastgroup if m.lastgroup in _MAKERS else next(k for k in _MAKERS if k != "email" and m.group(k))


def replaced(text: str, permute: Permutation, known: dict) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with pseudonyms, and (start, end, kind) of what they replace, in code points."""
    spans = []
    if "@" in text:
        spans = [(m.start(), m.end(), "email") for m in _EMAIL.finditer(text)]
    taken = {i for a, b, _ in spans for i in range(a, b)}
    if any(map(text.__contains__, "0123456789")):
        spans += [s for s in _matches(text) if s[0] not in taken and s[1] - 1 not in taken]
    out, found, at = [], [], 0
    for a, b, kind in sorted(spans):
        old = text[a:b]
        if (kind, old) not in known:
            if len(known) > 100_000:
                known.clear()
            known[kind, old] = _MAKERS[kind](old, permute)
        if (new := known[kind, old]) is not None and new != old:
            out += [text[at:a], new]
            found.append((a, b, kind))
            at = b
    return "".join([*out, text[at:]]), found


_RESULT = "struct<text:string,spans:array<struct<kind:string,start:bigint,end:bigint>>>"


def _column(text: Column, key: bytes, forward: bool) -> Column:
    @arrow_udf(_RESULT)
    def of(texts: pa.Array) -> pa.Array:
        permute, known, out = Permutation(key, forward), {}, []
        for text in texts.to_pylist():
            new, spans = (None, []) if text is None else replaced(text, permute, known)
            out.append({"text": new, "spans": [{"kind": k, "start": a, "end": b} for a, b, k in spans]})
        span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        return pa.array(out, pa.struct([("text", pa.string()), ("spans", pa.list_(span))]))

    return of(text)


def pseudonymised(docs: DataFrame, key: bytes = KEY, text_col: str = "text", restore: bool = False) -> DataFrame:
    """``docs`` with pseudonyms in ``text_col``, and ``pii``: kind, start and end of what was replaced.

    Starts and ends are code points of the text given. A number that fails its check (a card number
    by its check digit, an address by its range, a date by the calendar) stays as it is. A null text
    stays null and has no spans; a column ``pii`` is replaced. Rows do not depend on each other, so
    repeated rows and equal values come out alike. ``restore`` undoes it with the same key.
    """
    small_batches(docs.sparkSession)
    out = docs.withColumn("__new", _column(F.col(f"`{text_col}`"), key, not restore))
    kept = [F.col("__new.text").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c != "pii"]
    return out.select(*kept, F.col("__new.spans").alias("pii"))


def op6_pii_pseudonyms(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` with their new texts, the number of values replaced by kind, and their places."""
    docs = pseudonymised(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    of = lambda kind: F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    spans = F.array_join(F.transform("pii", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return docs.select("doc_id", "text", *[of(k) for k in KINDS], spans.alias("spans"))
