"""Pseudonyms for personal values: a keyed Feistel permutation inside each value's own format.

A value is found by its format and, where the format has a check, validated: card numbers by the
Luhn digit, IBANs by their remainder, dates by the calendar, addresses by their octets. Its variable
digits and letters, read as one number of a mixed-radix domain, go through a Feistel network under a
secret key. The result is a value of the same format that passes the same check, and equal values,
however they are written, have equal pseudonyms in all documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from datetime import date

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starloom.llm import common as c

ROUNDS = 10
FIRST_DAY, LAST_DAY = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
HEX = "0123456789abcdef"

# What is looked for. Groups named after the kinds; the order decides where two could match.
SOURCE = r"""
    (?P<email>(?<![\w.+-])[A-Za-z0-9][\w.+-]{0,63}@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,24}(?![\w-]))
  | (?P<assigned>(?i:password|passwd|pwd|secret|token|api[_-]?key)\s?[=:]\s?["']?\K[A-Za-z0-9_\-/+.]{6,128}(?=["']|\b))
  | (?P<access>(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9]))
  | (?P<iban>(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:\ ?[A-Z0-9]{4}){2,7}(?:\ ?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))
  | (?P<ip>(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d))
  | (?P<iso>(?<![\w/-])\d{4}-\d{2}-\d{2}(?=T\d{2}(?::?\d{2}|(?!\w))|(?![\w/-])))
  | (?P<slash>(?<![\w/])\d{1,2}/\d{1,2}/\d{4}(?![\w/]))
  | (?P<dotted>(?<![\w.])\d{1,2}\.\d{1,2}\.\d{4}(?!\w|\.\d))
  | (?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))
  | (?P<card>(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-]|\.\d))
  | (?P<phone>(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]?\d{3,4}(?![\w-]|\.\d)
            |(?<![\w+])\+\d{8,15}(?!\w))
"""
PATTERN = regex.compile(SOURCE, regex.VERBOSE)
KINDS = regex.findall(r"\(\?P<(\w+)>", SOURCE)
# what may stand at a place where a match of each kind was no value
LATER = {kind: regex.compile(SOURCE[SOURCE.index(f"(?P<{after}>"):], regex.VERBOSE) for kind, after in zip(KINDS, KINDS[1:], strict=False)}
GROUP = regex.compile(r"[A-Za-z0-9]+")
# lengths and first digits that issuers use
ISSUED = regex.compile(r"4(?:\d{12}|\d{15}|\d{18})|(?:5[1-5]|2[2-7])\d{14}|3[47]\d{13}|3(?:0[0-5]|[68]\d)\d{11}|(?:35|6[0-9])\d{14,17}")
HINT = regex.compile(r"[0-9@]|(?i:password|passwd|pwd|secret|token|key)\s?[=:]")


class Feistel:
    """Keyed permutations of {0 .. size - 1}."""

    def __init__(self, key: bytes) -> None:
        self.key = key

    def _round(self, kind: str, i: int, value: int, size: int) -> int:
        message = f"{kind}:{i}:{size}:{value}".encode()
        return int.from_bytes(hashlib.blake2b(message, key=self.key, digest_size=32).digest(), "big") % size

    def _once(self, kind: str, value: int, left_size: int, right_size: int) -> int:
        left, right = divmod(value, right_size)
        for i in range(0, ROUNDS, 2):
            left = (left + self._round(kind, i, right, left_size)) % left_size
            right = (right + self._round(kind, i + 1, left, right_size)) % right_size
        return left * right_size + right

    def permute(self, kind: str, value: int, size: int) -> int:
        """A permutation of the first ``size`` numbers: the walk goes on until it is back among them."""
        right = 1
        while right * right < size:
            right += right if right * right * 4 < size else 1 if size < 1 << 16 else max(1, right // 64)
        left = -(-size // right)
        while True:
            value = self._once(f"{kind}:{size}", value, left, right)
            if value < size:
                return value

    def symbols(self, kind: str, text: str, alphabet: Callable[[str], str | None]) -> str:
        """Permutes the characters that have an alphabet together; the others stay."""
        sets = [alphabet(ch) for ch in text]
        size, value = 1, 0
        for ch, letters in zip(text, sets, strict=True):
            if letters:
                size, value = size * len(letters), value * len(letters) + letters.index(ch)
        value = self.permute(kind, value, size)
        out = []
        for ch, letters in zip(reversed(text), reversed(sets), strict=True):
            if letters:
                value, at = divmod(value, len(letters))
                ch = letters[at]
            out.append(ch)
        return "".join(reversed(out))


def _by_class(ch: str) -> str | None:
    return next((s for s in (DIGITS, LOWER, UPPER) if ch in s), None)


def _hex_or_class(text: str) -> Callable[[str], str | None]:
    return (lambda ch: HEX if ch in HEX else None) if all(ch in HEX for ch in text) else _by_class


def luhn_digit(payload: str) -> str:
    total = 0
    for i, ch in enumerate(reversed(payload)):
        n = int(ch) * (2 - i % 2)
        total += n - 9 if n > 9 else n
    return str(-total % 10)


def iban_check(country: str, account: str) -> str:
    number = "".join(str(int(ch, 36)) for ch in account + country + "00")
    return f"{98 - int(number) % 97:02d}"


def _refill(template: str, symbols: str) -> str:
    """The template with its letters and digits replaced in order."""
    rest = iter(symbols)
    return "".join(next(rest) if ch.isalnum() else ch for ch in template)


def _valid_ssn(digits: str) -> bool:
    return digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000"


class Pseudonyms:
    """Replaces the values of a text; None for a match that is not a valid value."""

    def __init__(self, key: bytes) -> None:
        self.feistel = Feistel(key)
        self.known: dict[tuple[str, str], str | None] = {}

    def text(self, text: str) -> tuple[str, list[tuple[str, int, int]]]:
        """The text with pseudonyms, and (kind, start, end) of each in the new text."""
        if not HINT.search(text):
            return text, []
        out, spans, last, size = [], [], 0, 0
        for kind, start, end in self.found(text):
            new = self.value(kind, text[start:end])
            out += (text[last:start], new)
            size += start - last
            spans.append((kind, size, size + len(new)))
            size += len(new)
            last = end
        return "".join([*out, text[last:]]), spans

    def found(self, text: str) -> Iterator[tuple[str, int, int]]:
        """(kind, start, end) of the values of a text.

        Where a match is no value, a shorter run of its groups may be one, or a match of a later kind
        at its place; otherwise the search goes on behind the first group of the match.
        """
        match = PATTERN.search(text)
        while match:
            kind, (start, end) = match.lastgroup, match.span()
            span = (start, end) if self.value(kind, match[0]) is not None else self._inside(kind, text, start, end)
            if span:
                yield kind, *span
                match = PATTERN.search(text, span[1])
            else:
                later = LATER[kind].match(text, start) if kind in LATER else None
                match = later or PATTERN.search(text, GROUP.search(text, start).end())

    def _inside(self, kind: str, text: str, start: int, end: int) -> tuple[int, int] | None:
        """The shorter run of whole groups of a rejected card or IBAN that is a value, the likeliest if there are several."""
        if kind not in ("card", "iban"):
            return None
        groups = [m.span() for m in GROUP.finditer(text, start, end)]
        runs = []
        for i, (x, _) in enumerate(groups if kind == "card" else groups[:1]):
            for _, y in groups[i:]:
                digits = "".join(GROUP.findall(text, x, y))
                if kind == "iban":
                    good = self._iban(text[x:y]) is not None
                else:
                    good = 13 <= len(digits) <= 19 and luhn_digit(digits[:-1]) == digits[-1]
                if good:
                    # what a hyphen joins belongs together
                    issued, whole = ISSUED.fullmatch(digits) is not None, "-" not in (text[x - 1: x], text[y: y + 1])
                    runs.append((issued and whole, issued, whole, y - x, -x, y))
        if not runs:
            return None
        *_, x, y = max(runs)
        return -x, y

    def value(self, kind: str, value: str) -> str | None:
        if (kind, value) not in self.known:
            if len(self.known) > 100_000:
                self.known.clear()
            self.known[kind, value] = getattr(self, f"_{kind}")(value)
        return self.known[kind, value]

    def _email(self, value: str) -> str:
        local, _, domain = value.lower().partition("@")
        name, dot, top = domain.rpartition(".")
        return f"{self.feistel.symbols('local', local, _by_class)}@{self.feistel.symbols('domain', name, _by_class)}{dot}{top}"

    def _assigned(self, value: str) -> str:
        return self.feistel.symbols("secret", value, _hex_or_class(value))

    def _access(self, value: str) -> str:
        return value[:4] + self.feistel.symbols("access", value[4:], lambda ch: UPPER + DIGITS)

    def _iban(self, value: str) -> str | None:
        plain = value.replace(" ", "")
        if not 15 <= len(plain) <= 34 or iban_check(plain[:2], plain[4:]) != plain[2:4]:
            return None
        account = self.feistel.symbols(f"iban{plain[:2]}", plain[4:], _by_class)
        return _refill(value, plain[:2] + iban_check(plain[:2], account) + account)

    def _ip(self, value: str) -> str | None:
        octets = [int(o) for o in value.split(".")]
        if max(octets) > 255 or any(len(o) > 1 and o[0] == "0" for o in value.split(".")):
            return None
        number = self.feistel.permute("ip", int.from_bytes(bytes(octets), "big"), 1 << 32)
        return ".".join(map(str, number.to_bytes(4, "big")))

    def _date(self, year: str, month: str, day: str) -> date | None:
        try:
            found = date(int(year), int(month), int(day)).toordinal()
        except ValueError:
            return None
        if not FIRST_DAY <= found <= LAST_DAY:
            return None
        return date.fromordinal(FIRST_DAY + self.feistel.permute("date", found - FIRST_DAY, LAST_DAY - FIRST_DAY + 1))

    def _iso(self, value: str) -> str | None:
        new = self._date(*value.split("-"))
        return new and new.isoformat()

    def _slash(self, value: str) -> str | None:
        first, second, year = value.split("/")
        if new := self._date(year, first, second):  # month first, unless it is none
            return f"{new.month:02d}/{new.day:02d}/{new.year}"
        new = self._date(year, second, first)
        return new and f"{new.day:02d}/{new.month:02d}/{new.year}"

    def _dotted(self, value: str) -> str | None:
        day, month, year = value.split(".")
        new = self._date(year, month, day)
        return new and f"{new.day:02d}.{new.month:02d}.{new.year}"

    def _ssn(self, value: str) -> str | None:
        digits = value.replace("-", "")
        if not _valid_ssn(digits):
            return None
        while True:
            digits = self.feistel.symbols("ssn", digits, lambda ch: DIGITS)
            if _valid_ssn(digits):
                return _refill(value, digits)

    def _card(self, value: str) -> str | None:
        digits = "".join(ch for ch in value if ch.isdigit())
        if luhn_digit(digits[:-1]) != digits[-1]:
            return self._phone(value) if len(digits) <= 15 and "-" in value else None
        body = digits[0] + self.feistel.symbols("card", digits[1:-1], lambda ch: DIGITS)
        return _refill(value, body + luhn_digit(body))

    def _phone(self, value: str) -> str | None:
        digits = "".join(ch for ch in value if ch.isdigit())
        if not 8 <= len(digits) <= 15:
            return None
        # the last ten digits are the subscriber's, however the country code is written
        keep = max(0, len(digits) - 10)
        new = self.feistel.symbols("phone", digits[keep:], lambda ch: DIGITS)
        return _refill(value, digits[:keep] + new)


SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def _replaced(key: bytes, at: int, out: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Pseudonyms(key)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            texts, spans = [], []
            for scalar in batch.column(at):
                text = scalar.as_py()
                text, found = (None, []) if text is None else names.text(text)
                texts.append(text)
                spans.append([{"kind": k, "start": s, "end": e} for k, s, e in found])
            columns = batch.columns
            columns[at] = pa.array(texts, batch.column(at).type)
            yield pa.record_batch([*columns, pa.array(spans, kind)], names=out)

    return run


def pseudonymise(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """``docs`` with its text pseudonymised, and ``pii_spans`` (kind, start, end in characters of the new text).

    Every row and every other column stays as it is, repeated rows and null ids included; a null
    text stays null and an empty one empty. A column named ``pii_spans`` is replaced. Whole texts
    are searched, on one pass without a shuffle. E-mail addresses count as equal whatever their
    case; a phone number keeps what stands before its last ten digits, a card its first digit,
    an e-mail address its top-level domain, an access key its first four letters.
    """
    docs = docs.drop("pii_spans")
    schema = T.StructType([*docs.schema.fields, T.StructField("pii_spans", SPANS)])
    return docs.mapInArrow(_replaced(key, docs.columns.index(text_col), schema.names), schema)


QUERY_KEY = b"a key for the registered query"  # a real run passes its own secret


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(c.documents(spark, sf_dir).select("doc_id", "text"), QUERY_KEY)
