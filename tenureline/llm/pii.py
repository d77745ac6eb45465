"""Personal data by anchor expansion.

One Aho-Corasick pass over the whole text finds anchors: at-signs, plus signs, digits, schemes
and cues of identifiers. From an anchor, a deterministic local parser expands to the boundaries
and validates. A parser starts where a leftmost search for its kind would, so its spans are the
leftmost non-overlapping ones; a failing candidate is dropped and not retried.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .texts import slices, strings

#: Kinds, in order: the base ones, then those the method adds.
BASE, ADDED = ("email", "ip", "card", "phone"), ("address", "account")
KINDS = BASE + ADDED
SCHEMES = ("http://", "https://", "ftp://", "ssh://", "sftp://", "mailto:", "tel:")
CUES = ("iban", "account", "acct", "ssn", "passport", "password", "passwd", "token", "api_key", "apikey", "secret")
KEY_PREFIX = "AKIA"

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ADDRESS = re.compile(r"[^\s<>\"'`{}|\\^]+")
_KEY = re.compile(r"AKIA[A-Z0-9]{16}(?![A-Za-z0-9])")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![A-Za-z0-9])")
_AFTER_CUE = re.compile(r"[ \t]{0,4}(?:no\.?|number|nr\.?|#)?[ \t]{0,4}[:=][ \t]{0,4}[\"']?", re.I)
_IDENTIFIER = re.compile(r"[A-Za-z0-9][A-Za-z0-9_+/=.-]{5,}")


def luhn(digits: str) -> bool:
    total = sum(int(x) for x in digits[-1::-2])
    return (total + sum(sum(divmod(2 * int(x), 10)) for x in digits[-2::-2])) % 10 == 0


def iban(text: str) -> bool:
    """Check digits by remainder 97."""
    plain = text.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join(str(int(x, 36)) for x in plain[4:] + plain[:4])) % 97 == 1


def anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for word, kind in [("@", "email"), ("+", "phone"), *((d, "digit") for d in "0123456789"), (KEY_PREFIX, "key")]:
        found.add_word(word, (kind, len(word)))
    for words, kind in ((SCHEMES, "address"), (CUES, "cue")):
        for word in words:
            for form in {word, word.upper(), word.capitalize()}:
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


class Finder:
    def __init__(self):
        self.anchors = anchors()

    def spans(self, text: str) -> dict[str, list[tuple[int, int]]]:
        """Spans of every kind in code points, end exclusive, by start."""
        found: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
        past = dict.fromkeys(KINDS, 0)
        for last, (kind, length) in self.anchors.iter(text):
            at = last - length + 1
            if kind == "digit":
                self._number(text, at, found, past)
            elif kind == "email":
                self._email(text, at, found, past)
            elif kind == "phone":
                if at >= past["phone"] and (m := _PHONE.match(text, at)):
                    past["phone"] = m.end()
                    if 9 <= sum(x.isdigit() for x in m[0]) <= 15:
                        found["phone"].append(m.span())
            elif kind == "address":
                self._address(text, at, last + 1, found, past)
            elif at >= past["account"] and (at == 0 or not text[at - 1].isalnum()):
                self._account(text, at, last + 1, kind, found, past)
        return found

    @staticmethod
    def _number(text: str, at: int, found: dict, past: dict) -> None:
        if at >= past["card"] and (m := _CARD.match(text, at)):
            past["card"] = m.end()
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                found["card"].append(m.span())
        # within a run of digits only its start can begin an address
        starts = at == 0 or not "0" <= text[at - 1] <= "9"
        if starts and at >= past["ip"] and (m := _IP.match(text, at)):
            past["ip"] = m.end()
            if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
                found["ip"].append(m.span())

    @staticmethod
    def _email(text: str, at: int, found: dict, past: dict) -> None:
        start = at
        while start > past["email"] and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            past["email"] = m.end()
            found["email"].append((start, m.end()))

    @staticmethod
    def _address(text: str, at: int, body: int, found: dict, past: dict) -> None:
        if at < past["address"] or (at and text[at - 1].isalnum()) or not (m := _ADDRESS.match(text, body)):
            return
        end = body + len(m[0].rstrip(".,;:!?)]"))
        if end > body and text[body].isalnum() or text[body : body + 1] == "+":
            past["address"] = end
            found["address"].append((at, end))

    @staticmethod
    def _account(text: str, at: int, body: int, kind: str, found: dict, past: dict) -> None:
        """A key with its prefix; else an identifier after a cue and a sign: an IBAN by its check
        digits, anything else only if it has a digit."""
        if kind == "key":
            m = _KEY.match(text, at)
        else:
            sign = _AFTER_CUE.match(text, body)
            if sign is None:
                sign = re.compile(r"[ \t]{1,4}").match(text, body)
                m = _IBAN.match(text, sign.end()) if sign else None
                m = m if m and iban(m[0]) else None
            else:
                m = _IBAN.match(text, sign.end())
                if not (m and iban(m[0])):
                    m = _IDENTIFIER.match(text, sign.end())
                    m = m if m and any("0" <= x <= "9" for x in m[0]) else None
        if m:
            past["account"] = m.end()
            found["account"].append(m.span())


def listed(spans: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind in kinds for start, end in spans[kind])


def masked(text: str, spans: dict[str, list[tuple[int, int]]]) -> str:
    """Every span, or run of overlapping spans, replaced by the kind of its first one."""
    flat = sorted((start, -end, kind) for kind, own in spans.items() for start, end in own)
    out, at = [], 0
    for start, end, kind in flat:
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, -end)
    return "".join([*out, text[at:]])


def found_spans(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_<kind> for every kind, base_sha256, spans)`` for every whole text.

    ``base_sha256`` digests the spans of the base kinds, ``spans`` lists all. Defined cases: a
    null text is empty and has no spans; repeated rows each give a row; a null doc_id stays
    null; an empty table gives an empty table; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder()
        for part in slices(batches):
            found = [finder.spans(text) for text in strings(part.column(1))]
            columns = [part.column(0), *(pa.array([len(x[kind]) for x in found], pa.int64()) for kind in KINDS)]
            columns.append(pa.array([hashlib.sha256(listed(x, BASE).encode()).hexdigest() for x in found], pa.string()))
            columns.append(pa.array([listed(x, KINDS) for x in found], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans"])

    counts = ", ".join(f"n_{kind} long" for kind in KINDS)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, f"doc_id long, {counts}, base_sha256 string, spans string")


def without_spans() -> Column:
    """The column ``text`` with every span masked; null stays null, texts without spans stay."""

    @F.arrow_udf("string")
    def mask(texts: pa.Array) -> pa.Array:
        finder = Finder()
        return pa.array([None if x is None else masked(x, finder.spans(x)) for x in texts.to_pylist()], pa.string())

    return mask(F.col("text"))
