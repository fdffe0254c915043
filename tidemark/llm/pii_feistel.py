"""Personal data: format-preserving Feistel pseudonyms.

Numbers and dates that pass their own validity rule are replaced by a keyed permutation of the values of the same format:
the replacement is valid by the same rule, has the same separators and lengths (of addresses the length may differ), and equal values get equal replacements in
every document, so records stay linked while nobody without the key can tell whose they are.

kind   rule                                                     permuted within
card   13-19 digits, plain or in groups, Luhn                   numbers of that length and first digit; check digit made anew
phone  North American, any codes after +1 or in (ddd) ddd-dddd, assignable and other codes, each among themselves, and any line
       else assignable ones; or + and 7-15 digits, plain or in  number; digits after the country code
       groups with one space, dot or hyphen between
ssn    ddd-dd-dddd with assignable area, group and serial       assignable numbers
iban   country, check digits modulo 97, account                 accounts with digits and letters at the same places; check made anew
ip     four numbers up to 255                                   all addresses
date   y-m-d, y/m/d, d.m.y, d/m/y or m/d/y that exist, 1900 on; dates 1900-2099 that are valid in the same readings and have as
       y-m-d and y/m/d also before a T with a time              many digits in each place
email  local part before a domain                               local parts with digits and letters at the same places, each letter
                                                                of its own alphabet and case; the domain stays

The permutation is a Feistel network on a product of two near-equal moduli with a keyed hash as round function; values outside
the format's range are permuted again until they fall inside (cycle walking), so it is a bijection and `restore` inverts it.

Nulls, ties, repeats: a null text stays null with no findings; an empty one stays empty; every row is rewritten on its own,
null or repeated ids included; an empty table gives an empty result; further columns pass through pseudonymise_table().
"""

from __future__ import annotations

import calendar
import hashlib
import math
import re
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import STEP_BYTES, narrow, ship, steps

ROUNDS = 10
KINDS = ("card", "phone", "ssn", "iban", "ip", "date", "email")


class Permutation:
    """A keyed bijection of range(size) for each tweak (the kind of value and what of it stays)."""

    def __init__(self, key: bytes, tweak: str, size: int):
        self.size = size
        self.a = max(1, math.isqrt(size - 1) + 1) if size > 1 else 1
        self.b = -(-size // self.a)
        short = key if len(key) <= hashlib.blake2b.MAX_KEY_SIZE else hashlib.blake2b(key).digest()
        self.key = hashlib.blake2b(tweak.encode(), key=short, digest_size=32).digest()

    def _round(self, i: int, value: int) -> int:
        return int.from_bytes(hashlib.blake2b(b"%d|%d" % (i, value), key=self.key, digest_size=32).digest(), "big")

    def _once(self, x: int, order, sign: int) -> int:
        left, right = divmod(x, self.b)
        for i in order:
            if i % 2:
                right = (right + sign * self._round(i, left)) % self.b
            else:
                left = (left + sign * self._round(i, right)) % self.a
        return left * self.b + right

    def forward(self, x: int, inside=None) -> int:
        while True:
            x = self._once(x, range(ROUNDS), 1)
            if x < self.size and (inside is None or inside(x)):
                return x

    def backward(self, x: int, inside=None) -> int:
        while True:
            x = self._once(x, range(ROUNDS - 1, -1, -1), -1)
            if x < self.size and (inside is None or inside(x)):
                return x


def luhn_digit(payload: str) -> str:
    """The digit that completes the payload."""
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def iban_remainder(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def refill(shape: str, symbols: str) -> str:
    """shape with its letters and digits replaced, in order."""
    it = iter(symbols)
    return "".join(next(it) if c.isalnum() else c for c in shape)


ASCII = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


@lru_cache(4096)
def alphabet(c: str) -> str:
    """The characters that c may be replaced by: those of its class, or beyond ASCII the letters and digits of its own kind among
    the 128 code points that it lies in. Empty for others, which stay."""
    if c.isascii():
        return next((t for t in ASCII if c in t), "")
    if not c.isalnum():
        return ""
    low = ord(c) & ~127
    return "".join(x for x in map(chr, range(low, low + 128)) if unicodedata.category(x) == unicodedata.category(c) and x.isalnum())


def pack(text: str) -> tuple[int, int, str]:
    """Letters and digits as one number in mixed radix, how many such there are, and the pattern of classes."""
    value, size, pattern = 0, 1, ""
    for c in text:
        table = alphabet(c)
        if table:
            value, size = value * len(table) + table.index(c), size * len(table)
        pattern += table[0] if table else c
    return value, size, pattern


def unpack(value: int, pattern: str) -> str:
    out = []
    for c in reversed(pattern):
        if table := alphabet(c):
            value, k = divmod(value, len(table))
            out.append(table[k])
        else:
            out.append(c)
    return "".join(reversed(out))


def _readings(a: int, b: int, y: int) -> tuple[bool, bool]:
    """Whether a/b/y exists as day/month and as month/day."""
    ok = lambda d, m: 1 <= m <= 12 and 1 <= d <= calendar.monthrange(y, m)[1]
    return ok(a, b), ok(b, a)


def _widths(parts: list[str]):
    """The digits of each number (empty if all have two), and whether others can be written with as many."""
    short = [len(p) == 1 for p in parts]
    wide = "".join(str(len(p)) for p in parts) if any(short) else ""
    return wide, lambda *values: not any(s and v > 9 for s, v in zip(short, values))


def _padded(value: int, like: str) -> str:
    return str(value).zfill(len(like))


#: Digits are ASCII ones: those of other scripts have no place in the formats, and would come back as ASCII.
NUMBER = re.compile(
    r"""(?<![\w.+-])(?:
      (?P<ymd>(?:19|20)[0-9][0-9]([-/])[0-9][0-9]?\2[0-9][0-9]?(?:(?=T[0-9])|(?![\w/-])))
    | (?P<dmy>[0-9][0-9]?([./])[0-9][0-9]?\4(?:19|20)[0-9][0-9](?![\w/]))
    | (?P<ssn>[0-9]{3}-[0-9][0-9]-[0-9]{4}(?![\w-]))
    | (?P<card>(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\7[0-9]{4}\7[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\8[0-9]{5})(?![\d-]))
    | (?P<nanp>(?:(?:\+?1[ .-]?)?\([0-9]{3}\)[ ]?[0-9]{3}|\+1[ .-]?[0-9]{3}[ .-][0-9]{3}|(?:1[ .-]?)?[2-9][0-9][0-9][ .-][2-9][0-9][0-9])[ .-][0-9]{4}(?!\d))
    | (?P<ip>[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?!\.?[0-9]))
    | (?P<iban>[A-Z]{2}[0-9][0-9](?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))
    )|(?<!\w)(?P<plus>\+1(?:[ .-]?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}|(?:[ .-]?[0-9]){10})(?!\d))
    |(?<![\w+])(?P<intl>\+(?![0-9]{1,3}[ -](?:[0-9]{4}[ -]){3}[0-9]{4}(?!\d))  # no card after a sign
      (?:[1-9](?:[ .-]?[0-9]){6}
        (?:(?:[ ](?![0-9]{4}[/-][0-9][0-9]?[/-][0-9]|[0-9][0-9]?[./][0-9][0-9]?[./][0-9]{4}(?!\d)|[0-9]{3}-[0-9][0-9]-[0-9]{4}(?!\d)|[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9]))|[.-])?[0-9]){0,8}  # up to a value of another kind
      |0[0-9]{0,2}(?:[ .-][0-9]{2,4}){2,4})(?!\d))""",
    re.X,
)
#: Country codes: one or two digits where those are given out, three elsewhere.
COUNTRY = re.compile(r"1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}")
#: A local part has 64 characters at most.
EMAIL = re.compile(r"(?<![\w.%+-])([\w.%+-]{1,64})@([^\W_][\w-]{0,62}(?:\.[\w-]{1,63})+)")


class Pseudonyms:
    def __init__(self, key: bytes):
        self.key = key
        self._permutation = lru_cache(4096)(lambda tweak, size: Permutation(key, tweak, size))

    def _walk(self, tweak: str, size: int, x: int, back: bool, inside=None) -> int:
        p = self._permutation(tweak, size)
        return p.backward(x, inside) if back else p.forward(x, inside)

    def card(self, text: str, back: bool = False) -> str | None:
        digits = re.sub(r"\D", "", text)
        if luhn_digit(digits[:-1]) != digits[-1]:
            return None
        n = len(digits) - 2
        body = digits[0] + str(self._walk(f"card{digits[0]}", 10**n, int(digits[1:-1]), back)).zfill(n)
        return refill(text, body + luhn_digit(body))

    def nanp(self, text: str, back: bool = False) -> str | None:
        digits = re.sub(r"\D", "", text)
        codes, line = (int(digits[-10:-7]), int(digits[-7:-4])), int(digits[-4:])
        # codes from 200 on are assignable; others, found after +1 or with parentheses, are permuted among themselves
        low = [200 if c >= 200 else 0 for c in codes]
        area, exchange = (800 if at else 200 for at in low)
        tweak = "nanp" if all(low) else f"nanp{low[0]},{low[1]}"
        x = self._walk(tweak, area * exchange * 10000, ((codes[0] - low[0]) * exchange + codes[1] - low[1]) * 10000 + line, back)
        rest, line = divmod(x, 10000)
        first, second = divmod(rest, exchange)
        return refill(text, digits[:-10] + f"{first + low[0]:03d}{second + low[1]:03d}{line:04d}")

    plus = nanp

    def intl(self, text: str, back: bool = False) -> str | None:
        digits = re.sub(r"\D", "", text)
        if not 7 <= len(digits) <= 15:
            return None
        country = COUNTRY.match(digits)[0]
        n = len(digits) - len(country)
        return refill(text, country + str(self._walk(f"intl{country}", 10**n, int(digits[len(country) :]), back)).zfill(n))

    def ssn(self, text: str, back: bool = False) -> str | None:
        area, group, serial = map(int, text.split("-"))
        good = lambda x: 0 < x // 10**6 < 900 and x // 10**6 != 666 and x // 10000 % 100 and x % 10000
        x = (area * 100 + group) * 10000 + serial
        if not good(x):
            return None
        x = self._walk("ssn", 900 * 10**6, x, back, good)
        return f"{x // 10**6:03d}-{x // 10000 % 100:02d}-{x % 10000:04d}"

    def iban(self, text: str, back: bool = False) -> str | None:
        plain = text.replace(" ", "")
        if not 15 <= len(plain) <= 34 or iban_remainder(plain) != 1:
            return None
        value, size, pattern = pack(plain[4:])
        account = unpack(self._walk(f"iban{plain[:2]}{pattern}", size, value, back), pattern)
        check = 98 - iban_remainder(f"{plain[:2]}00{account}")
        return refill(text, f"{plain[:2]}{check:02d}{account}")

    def ip(self, text: str, back: bool = False) -> str | None:
        parts = [int(x) for x in text.split(".")]
        if max(parts) > 255:
            return None
        x = self._walk("ip", 1 << 32, int.from_bytes(bytes(parts), "big"), back)
        return ".".join(map(str, x.to_bytes(4, "big")))

    def ymd(self, text: str, back: bool = False) -> str | None:
        sep = text[4]
        parts = text.split(sep)
        y, m, d = map(int, parts)
        if not (1 <= m <= 12 and _readings(d, m, y)[0]):
            return None
        wide, fits = _widths(parts[1:])
        good = lambda x: _readings(x % 31 + 1, x // 31 % 12 + 1, x // 372 + 1900)[0] and fits(x // 31 % 12 + 1, x % 31 + 1)
        x = self._walk(f"ymd{wide}", 200 * 372, (y - 1900) * 372 + (m - 1) * 31 + d - 1, back, good)
        return f"{x // 372 + 1900}{sep}{_padded(x // 31 % 12 + 1, parts[1])}{sep}{_padded(x % 31 + 1, parts[2])}"

    def dmy(self, text: str, back: bool = False) -> str | None:
        sep = "." if "." in text else "/"
        parts = text.split(sep)
        a, b, y = map(int, parts)
        same = lambda r: r[:1] if sep == "." else r  # noqa: E731  with dots, the day comes first
        kind = same(_readings(a, b, y))
        if not any(kind):
            return None
        wide, fits = _widths(parts[:2])
        good = lambda x: same(_readings(x // 31 % 31 + 1, x % 31 + 1, x // 961 + 1900)) == kind and fits(x // 31 % 31 + 1, x % 31 + 1)
        x = self._walk(f"dmy{sep}{wide}", 200 * 961, (y - 1900) * 961 + (a - 1) * 31 + b - 1, back, good)
        return f"{_padded(x // 31 % 31 + 1, parts[0])}{sep}{_padded(x % 31 + 1, parts[1])}{sep}{x // 961 + 1900}"

    def email(self, local: str, back: bool = False) -> str:
        value, size, pattern = pack(local)
        return unpack(self._walk(f"email{pattern}", size, value, back), pattern) if size > 1 else local

    GROUPS = {"ymd": "date", "dmy": "date", "ssn": "ssn", "card": "card", "nanp": "phone", "plus": "phone", "intl": "phone", "ip": "ip", "iban": "iban"}

    def rewrite(self, text: str, back: bool = False) -> tuple[str, list[tuple[int, int, str]]]:
        """The text with pseudonyms, and (start, end, kind) of what was replaced, in the text given."""
        found: list[tuple[int, int, str, str]] = []
        if "@" in text:
            for m in EMAIL.finditer(text):
                found.append((*m.span(1), "email", self.email(m[1], back)))
        taken = [(a, b) for a, b, *_ in found]
        at = k = 0
        while m := NUMBER.search(text, at):
            at = m.end()
            name = m.lastgroup
            new = getattr(self, name)(m[0], back)
            if new is None:
                at = m.start() + len(re.match(r"\+?\w+", m[0])[0])  # another value may begin within
                continue
            while k < len(taken) and taken[k][1] <= m.start():
                k += 1
            if k < len(taken) and taken[k][0] < m.end():
                continue
            found.append((*m.span(), self.GROUPS[name], new))
        if not found:
            return text, []
        found.sort()
        out, end = [], 0
        for a, b, _, new in found:
            out += [text[end:a], new]
            end = b
        out.append(text[end:])
        return "".join(out), [f[:3] for f in found]

    def restore(self, text: str) -> str:
        return self.rewrite(text, back=True)[0]


def _digit_rows(column: pa.Array):
    """Whether each text holds a digit or an @: others can hold nothing that is looked for."""
    import numpy as np

    from tidemark.llm import scan

    data, offsets = scan.raw(column)
    hit = ((data >= 0x30) & (data <= 0x39)) | (data == 0x40)
    return scan.sums(hit.astype(np.int64), offsets) > 0


def _rewrite(key: bytes, names: list[str], text_col: str, counts: bool):
    def run(batches):
        p = Pseudonyms(key)
        at = names.index(text_col)
        for whole in batches:
            for b in steps(whole, column=at, limit=4 * STEP_BYTES):
                some = _digit_rows(b.column(at))
                texts = b.column(at).to_pylist()
                found = [[] for _ in texts]
                for i in some.nonzero()[0].tolist():
                    if texts[i] is not None:
                        texts[i], found[i] = p.rewrite(texts[i])
                cols = [pa.array(texts, pa.string()) if k == at else b.column(k) for k in range(len(names))]
                if counts:
                    cols += [pa.array([sum(kind == f[2] for f in x) for x in found], pa.int64()) for kind in KINDS]
                yield pa.RecordBatch.from_arrays(cols, names=[*names, *[f"n_{kind}" for kind in KINDS]] if counts else names)

    return run


def pseudonymise(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text with pseudonyms, and how many of each kind were replaced."""
    ship(docs.sparkSession)
    slim = narrow(docs, doc_id=id_col, text=text_col)
    kind = slim.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text string, " + ", ".join(f"n_{k} long" for k in KINDS)
    return slim.mapInArrow(_rewrite(key, ["doc_id", "text"], "text", True), schema)


def pseudonymise_table(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """docs with pseudonyms in the text column; all rows and other columns stay."""
    ship(docs.sparkSession)
    return docs.mapInArrow(_rewrite(key, docs.columns, text_col, False), docs.schema)
