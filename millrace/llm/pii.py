"""Personal data in texts, by anchor expansion.

One Aho-Corasick automaton finds anchors: at-signs, schemes, digit pairs and dots between digits, plus signs before digits,
and cue words of accounts. At each anchor a small deterministic parser expands to the boundaries of the span and checks it.
Anchors come in text order, so "leftmost, not overlapping" per kind needs only the end of the last span of that kind.

Base kinds email, ip, card, phone follow fixed patterns; the kinds url, account, iban and handle are added by cues.
Positions are code points, ends exclusive. Whole texts are searched. Null and empty texts have no spans; repeated rows are
searched each; other columns pass through untouched.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Kinds in the order in which spans that begin at the same place are listed.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account", "iban", "handle")

# Words that announce an account or identity number.
CUES = ("account", "acct", "iban", "ssn", "passport", "konto", "kontonummer", "compte", "cuenta", "user id", "userid", "customer no")
SCHEMES = ("http://", "https://", "ftp://", "ssh://", "mailto:", "www.")

_LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_SPACED_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_URL_REST = re.compile(r"[^\s<>\"'`|\\^{}\[\]]+")
_AFTER_CUE = re.compile(r"(?:\s*(?:no|nr|number|num)\b\.?)?\s*[:=#]?\s*", re.IGNORECASE)
_NUMBER = re.compile(r"[A-Za-z]{0,2}[0-9][0-9A-Za-z-]{4,33}(?![0-9A-Za-z])")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_HANDLE = re.compile(r"@[A-Za-z0-9_]{3,32}")
_NOT_DIGIT = re.compile(r"[^0-9]")
# same positions, which str.lower doesn't keep
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    digits = string.digits
    for x in digits:
        found.add_word(f"{x}.", (2, "dot"))
        found.add_word(f"+{x}", (2, "plus"))
        for y in digits:
            for between in ("", " ", "-"):
                found.add_word(x + between + y, (2 + len(between), "digits"))
    found.add_word("@", (1, "at"))
    for words, kind in ((SCHEMES, "scheme"), (CUES, "cue")):
        for word in words:
            found.add_word(word, (len(word), kind))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def iban_ok(text: str) -> bool:
    """Whether the check digits of an account number are right (remainder 1 modulo 97)."""
    moved = text[4:] + text[:4]
    return 15 <= len(text) <= 34 and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


class Finder:
    """Finds spans in one text after another; holds the automaton and no other state."""

    def __init__(self) -> None:
        self.anchors = _automaton()

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        """(start, end, kind) by start, then kind as listed in ``KINDS``."""
        found: list[tuple[int, int, str]] = []
        past = dict.fromkeys(KINDS, 0)  # where the search for each kind goes on

        def keep(kind: str, start: int, end: int, valid: bool = True) -> None:
            past[kind] = end
            if valid:
                found.append((start, end, kind))

        for last, (length, kind) in self.anchors.iter(text.translate(_LOWER)):
            at = last - length + 1
            if kind == "digits":
                if at >= past["card"]:
                    run = _SPACED_DIGITS.match(text, at)
                    digits = _NOT_DIGIT.sub("", run[0])
                    keep("card", at, run.end(), 12 <= len(digits) <= 19 and luhn(digits))
            elif kind == "dot":
                self._address(text, at, past, keep)
            elif kind == "plus":
                if at >= past["phone"] and (run := _PHONE.match(text, at)):
                    keep("phone", at, run.end(), 9 <= len(_NOT_DIGIT.sub("", run[0])) <= 15)
            elif kind == "at":
                self._email(text, at, past, keep)
            elif kind == "scheme":
                if at >= past["url"] and (rest := _URL_REST.match(text, last + 1)):
                    end = last + 1 + len(rest[0].rstrip(".,;:!?)"))
                    keep("url", at, end, end > last + 1 and "." in text[at:end])
            else:
                self._account(text, at, last + 1, past, keep)
        found.sort(key=lambda s: (s[0], KINDS.index(s[2])))
        return found

    @staticmethod
    def _email(text: str, at: int, past: dict, keep) -> None:
        start = at
        while start > past["email"] and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1)
        if start < at and domain:
            keep("email", start, domain.end())
        elif at >= past["handle"] and (at == 0 or not text[at - 1].isalnum()) and (name := _HANDLE.match(text, at)):
            keep("handle", at, name.end())

    @staticmethod
    def _address(text: str, at: int, past: dict, keep) -> None:
        start = at
        while start > past["ip"] and "0" <= text[start - 1] <= "9":
            start -= 1
        if at >= past["ip"] and (run := _DOTTED.match(text, start)):
            parts = (part.lstrip("0") or "0" for part in run[0].split("."))
            keep("ip", start, run.end(), all(len(part) <= 3 and int(part) <= 255 for part in parts))

    @staticmethod
    def _account(text: str, at: int, end: int, past: dict, keep) -> None:
        if at and text[at - 1].isalnum() or at < past["account"]:
            return
        start = _AFTER_CUE.match(text, end).end()
        if start >= past["iban"] and (run := _IBAN.match(text, start)):
            # the longest run of characters whose check digits are right
            for stop in range(run.end(), start + 14, -1):
                if text[stop - 1] != " " and iban_ok(text[start:stop].replace(" ", "")):
                    keep("iban", start, stop)
                    break
        if number := _NUMBER.match(text, start):
            keep("account", start, number.end(), sum(c.isdigit() for c in number[0]) >= 5)


SPANS = T.StructType([
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("kind", T.StringType()),
    ]))),
])


def find_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``spans``: a list of (start, end, kind) for every row. One narrow pass; texts don't leave their task."""
    rows = docs.select(key, docs[text].cast("string").alias("text"))
    schema = T.StructType([rows.schema[0], *SPANS])
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder()
        for batch in batches:
            found = [
                [{"start": a, "end": b, "kind": k} for a, b, k in finder.spans(value.as_py() or "")] for value in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, spans)], names=[key, "spans"])

    return rows.mapInArrow(search, schema)


def masked(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with every span replaced by its kind; where spans overlap, the earlier and then the longer one counts."""
    out, past = [], 0
    for start, end, kind in sorted(spans, key=lambda s: (s[0], -s[1])):
        if start >= past:
            out += [text[past:start], f"[{kind.upper()}]"]
            past = end
    return "".join([*out, text[past:]])
