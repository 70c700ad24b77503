"""Format-preserving pseudonyms of personal data in texts.

Numbers and dates that pass their own checks (check digits, calendar, ranges) and mail
addresses are replaced by others of the same format: the variable part is a number below
some bound, and a keyed Feistel network permutes the numbers below that bound.  Networks
work on a power of four and are walked until they come out below the bound.  Equal values
get equal pseudonyms in every document, different values different ones, and whoever has
the key can reverse them.

What fails its check is no such value and stays as it is.  Null texts stay null and empty
ones empty; long texts are read whole.  Repeated rows get equal texts.  An empty table
gives no rows.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
# The span of dates, and the characters of mail names and account numbers.
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Characters of an account number by country.
_BY_LENGTH = {
    15: "NO",
    16: "BE",
    18: "DK FI FO GL NL",
    19: "MK SI",
    20: "AT BA EE KZ LT LU XK",
    21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST",
    26: "IS TR",
    27: "FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HU LB PL SV",
    29: "BR EG PS QA UA",
    30: "JO KW MU",
    31: "MT SC",
    32: "LC",
}
IBAN_LENGTHS = {country: n for n, countries in _BY_LENGTH.items() for country in countries.split()}
# Longer mail names are permuted in parts of so many characters.
MAIL_PART = 64

_NUMBERS = re.compile(
    r"""(?<![0-9A-Za-z.+-])(?:
      (?P<iban>[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])
    | (?P<date>(?:(?:19|20)[0-9]{2}(?P<s1>[-/.])[0-9]{2}(?P=s1)[0-9]{2}|[0-9]{2}(?P<s2>[-/.])[0-9]{2}(?P=s2)(?:19|20)[0-9]{2}))(?![0-9])
    | (?P<ssn>[0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])
    | (?P<ip>(?:[0-9]{1,3}\.){3}[0-9]{1,3})(?!\.?[0-9])
    | (?P<phone>(?:\+?1[ .-]?)?(?:\([0-9]{3}\)[ ]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4})(?![0-9])
    | (?P<abroad>\+[0-9]{1,3}(?:[ .-]?\(?[0-9]{2,4}\)?){2,5})(?![0-9])
    | (?P<card>[0-9]{13,19}|[0-9]{4}(?P<s3>[ -])[0-9]{4}(?P=s3)[0-9]{4}(?P=s3)[0-9]{1,7}|[0-9]{4}(?P<s4>[ -])[0-9]{6}(?P=s4)[0-9]{5})(?![0-9])
    )""",
    re.X,
)
_MAIL_NAME = frozenset(DIGITS + LOWER + UPPER + "._%+-")
_MAIL_HOST = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)*\.[A-Za-z]{2,24}")
_ANY = re.compile("[0-9@]")


class Permutation:
    """A keyed permutation of the numbers below ``size``, one per purpose."""

    def __init__(self, key: bytes, purpose: str, size: int) -> None:
        self.size = size
        self.half = max(1, -(-(size - 1).bit_length() // 2))
        self.mask = (1 << self.half) - 1
        self.base = hashlib.blake2b(f"{purpose}/{size}".encode(), key=key[:64], digest_size=32)

    def _round(self, i: int, half: int) -> int:
        out, wanted = b"", -(-self.half // 8)
        while len(out) < wanted:
            h = self.base.copy()
            h.update(b"%d/%d/%x" % (i, len(out), half))
            out += h.digest()
        return int.from_bytes(out[:wanted], "big") & self.mask

    def _once(self, x: int, order: range) -> int:
        left, right = x >> self.half, x & self.mask
        if order.step > 0:
            for i in order:
                left, right = right, left ^ self._round(i, right)
        else:
            for i in order:
                left, right = right ^ self._round(i, left), left
        return (left << self.half) | right

    def _walk(self, x: int, order: range) -> int:
        if self.size <= 1:
            return x
        x = self._once(x, order)
        while x >= self.size:
            x = self._once(x, order)
        return x

    def forth(self, x: int) -> int:
        return self._walk(x, range(ROUNDS))

    def back(self, x: int) -> int:
        return self._walk(x, range(ROUNDS - 1, -1, -1))


@lru_cache(maxsize=4096)
def permutation(key: bytes, purpose: str, size: int) -> Permutation:
    return Permutation(key, purpose, size)


def _mixed(key: bytes, purpose: str, values: list[int], bounds: list[int], back: bool) -> list[int]:
    """Permute a tuple of numbers, each below its own bound, as one number."""
    x, size = 0, 1
    for value, bound in zip(values, bounds, strict=True):
        x, size = x * bound + value, size * bound
    shuffled = permutation(key, purpose, size)
    x = shuffled.back(x) if back else shuffled.forth(x)
    out = []
    for bound in reversed(bounds):
        x, value = divmod(x, bound)
        out.append(value)
    return out[::-1]


def _characters(key: bytes, purpose: str, text: str, back: bool) -> str:
    """Permute digits among digits and letters among letters; other characters stay."""
    kinds = [next((k for k in (DIGITS, LOWER, UPPER) if c in k), "") for c in text]
    at = [i for i, k in enumerate(kinds) if k]
    shape = "".join("0" if k is DIGITS else "a" if k is LOWER else "A" for k in kinds if k)
    values = _mixed(key, f"{purpose}/{shape}", [kinds[i].index(text[i]) for i in at], [len(kinds[i]) for i in at], back)
    out = list(text)
    for i, value in zip(at, values, strict=True):
        out[i] = kinds[i][value]
    return "".join(out)


def _refill(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced in turn."""
    rest = iter(digits)
    return "".join(next(rest) if c in DIGITS else c for c in shape)


def luhn(digits: str) -> int:
    """Check sum modulo ten; 0 for valid numbers."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10


def _card(key: bytes, text: str, back: bool) -> str | None:
    digits = "".join(c for c in text if c in DIGITS)
    if not 13 <= len(digits) <= 19 or luhn(digits) or len(set(digits)) == 1:
        return None
    # The issuer's first digit stays, the check digit follows.
    middle = _characters(key, "card", digits[1:-1], back)
    check = -luhn(digits[0] + middle + "0") % 10
    return _refill(text, digits[0] + middle + str(check))


def _iban_number(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4]))


def _iban(key: bytes, text: str, back: bool) -> str | None:
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34 or _iban_number(plain) % 97 != 1:
        return None
    body = _characters(key, "iban" + plain[:2], plain[4:], back)
    check = 98 - _iban_number(plain[:2] + "00" + body) % 97
    rest = iter(f"{plain[:2]}{check:02d}{body}")
    return "".join(c if c == " " else next(rest) for c in text)


def _iban_ends(text: str) -> list[int]:
    """Where an account number that starts ``text`` may end: by its country first, then the longest first."""
    ends = [i for i in range(len(text), 0, -1) if i == len(text) or text[i] == " "]
    wanted = IBAN_LENGTHS.get(text[:2])
    return sorted(ends, key=lambda i: i - text.count(" ", 0, i) != wanted)


def _date(key: bytes, text: str, back: bool) -> str | None:
    sep = next(c for c in text if c not in DIGITS)
    parts = text.split(sep)
    orders = ((0, 1, 2),) if len(parts[0]) == 4 else ((2, 1, 0), (2, 0, 1))  # day first where both can be
    for year, month, day in orders:
        try:
            there = datetime.date(int(parts[year]), int(parts[month]), int(parts[day])).toordinal()
        except ValueError:
            continue
        name = "date" if orders[0] == (0, 1, 2) else "date-"
        if name == "date-" and (year, month, day) == (2, 1, 0) or name == "date":
            shuffled = permutation(key, "date", LAST_DAY - FIRST_DAY + 1)
            x = there - FIRST_DAY
            found = datetime.date.fromordinal(FIRST_DAY + (shuffled.back(x) if back else shuffled.forth(x)))
        else:
            # Month first: only dates that cannot be read day first, among themselves.
            late = _late_days()
            shuffled = permutation(key, "date-month-first", len(late))
            x = late.index(there)
            found = datetime.date.fromordinal(late[shuffled.back(x) if back else shuffled.forth(x)])
        out = [""] * 3
        out[year], out[month], out[day] = f"{found.year:04d}", f"{found.month:02d}", f"{found.day:02d}"
        return sep.join(out)
    return None


@lru_cache(maxsize=1)
def _late_days() -> tuple[int, ...]:
    return tuple(n for n in range(FIRST_DAY, LAST_DAY + 1) if datetime.date.fromordinal(n).day > 12)


def _ssn(key: bytes, text: str, back: bool) -> str | None:
    area, group, serial = (int(p) for p in text.split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    place = area - 1 - (area > 666)
    a, g, s = _mixed(key, "ssn", [place, group - 1, serial - 1], [898, 99, 9999], back)
    return f"{a + 1 + (a >= 665):03d}-{g + 1:02d}-{s + 1:04d}"


# Octets of one, two and three digits.
_OCTETS = {1: (0, 10), 2: (10, 90), 3: (100, 156)}


def _ip(key: bytes, text: str, back: bool) -> str | None:
    octets = text.split(".")
    if any(int(o) > 255 or str(int(o)) != o for o in octets):
        return None
    ranges = [_OCTETS[len(o)] for o in octets]
    shape = "".join(str(len(o)) for o in octets)
    values = [int(o) - low for o, (low, _) in zip(octets, ranges, strict=True)]
    found = _mixed(key, f"ip{shape}", values, [n for _, n in ranges], back)
    return ".".join(str(v + low) for v, (low, _) in zip(found, ranges, strict=True))


def _phone(key: bytes, text: str, back: bool) -> str | None:
    digits = "".join(c for c in text if c in DIGITS)
    nation, local = digits[:-10], digits[-10:]
    if local[0] in "01" or local[3] in "01":
        return None
    values = [int(local[0]) - 2, int(local[1:3]), int(local[3]) - 2, int(local[4:])]
    a, b, c, d = _mixed(key, "phone", values, [8, 100, 8, 10**6], back)
    return _refill(text, f"{nation}{a + 2}{b:02d}{c + 2}{d:06d}")


def _abroad(key: bytes, text: str, back: bool) -> str | None:
    digits = "".join(c for c in text if c in DIGITS)
    if not 8 <= len(digits) <= 15 or digits[0] == "0":
        return None
    return _refill(text, digits[:2] + _characters(key, "abroad" + digits[:2], digits[2:], back))


_KINDS: dict[str, Callable[[bytes, str, bool], str | None]] = {
    "iban": _iban,
    "date": _date,
    "ssn": _ssn,
    "ip": _ip,
    "phone": _phone,
    "abroad": _abroad,
    "card": _card,
}


def _mails(text: str) -> Iterator[tuple[int, int, int]]:
    """(start, at, end) of mail addresses, the at sign in between; none begins before the last one's end."""
    at, end = text.find("@"), 0
    while at >= 0:
        host = _MAIL_HOST.match(text, at + 1)
        start = at
        while start > end and text[start - 1] in _MAIL_NAME:
            start -= 1
        while start < at and text[start] in "._%+-":
            start += 1
        if start < at and host:
            end = host.end()
            yield start, at, end
        at = text.find("@", at + 1)


def _mail_name(key: bytes, host: str, name: str, back: bool) -> str:
    purpose = "mail@" + host.lower()
    out = [_characters(key, purpose, name[:MAIL_PART], back)]
    for at in range(MAIL_PART, len(name), MAIL_PART):
        out.append(_characters(key, f"{purpose}/{at}", name[at : at + MAIL_PART], back))
    return "".join(out)


def pseudonymised(text: str, key: bytes, back: bool = False) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and (kind, start, end) of what was replaced, in its own positions."""
    if not _ANY.search(text):
        return text, []
    found: list[tuple[int, int, str, str]] = []
    taken: list[tuple[int, int]] = []
    for start, at, end in _mails(text):
        found.append((start, end, "mail", _mail_name(key, text[at + 1 : end], text[start:at], back) + text[at:end]))
        taken.append((start, end))
    pos, mails = 0, iter([*taken, (len(text) + 1, 0)])
    mail = next(mails)
    while match := _NUMBERS.search(text, pos):
        while mail[1] and mail[1] <= match.start():
            mail = next(mails)
        kind = match.lastgroup if match.lastgroup in _KINDS else next(k for k in _KINDS if match[k])
        value, new = match[kind], None
        sizes = _iban_ends(value) if kind == "iban" else [len(value)]
        if mail[0] < match.end() and match.start() < mail[1]:
            sizes = [n for n in sizes if match.start() + n <= mail[0]]
            if not sizes:
                pos = mail[1]
                continue
        for size in sizes:
            new = _KINDS[kind](key, value[:size], back)
            if new is not None:
                break
        if new is None:
            pos = match.start() + 1
            continue
        found.append((match.start(), match.start() + size, kind, new))
        pos = match.start() + size
    out, done = [], 0
    for start, end, _, new in sorted(found):
        out += [text[done:start], new]
        done = end
    return "".join([*out, text[done:]]), [(kind, start, end) for start, end, kind, _ in sorted(found)]


def pseudonyms(docs: DataFrame, key: bytes) -> DataFrame:
    """(doc_id, text, n_private, spans) of every row; the texts hold pseudonyms.

    ``spans`` lists kind, start and end (code points of the original text).  One pass;
    nothing is shuffled.
    """
    if not key:
        raise ValueError("pseudonyms need a key")
    rows = docs.select("doc_id", F.col("text").cast("string"))
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                part = batch.slice(first, 1024)
                found = [(None, []) if t is None else pseudonymised(t, key) for t in part.column(1).to_pylist()]
                spans = [[{"kind": k, "start": s, "end": e} for k, s, e in found_in] for _, found_in in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([t for t, _ in found], pa.string()),
                        pa.array([len(s) for s in spans], pa.int64()),
                        pa.array(spans, pa.list_(span)),
                    ],
                    names=["doc_id", "text", "n_private", "spans"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    layout = f"doc_id {kind}, text string, n_private bigint, spans array<struct<kind: string, start: int, end: int>>"
    return rows.mapInArrow(work, layout)
