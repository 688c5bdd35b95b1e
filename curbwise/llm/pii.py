"""Operator 4: personal data by patterns, checksums and context.

Patterns propose spans; Luhn (cards) and mod-97 (IBANs) confirm them; words
nearby raise or lower the score of the rest. The four base kinds (email, ip,
card, phone) are always reported when they pass their checks. The method adds:

- ``iban``: two letters, two digits and 11 to 30 letters or digits, passing mod-97
  at some group end: at the country's length if it is known and passes, else at
  the last end that does;
- ``card`` inside a longer row of digit groups: any run of whole groups with 13 to
  19 digits in all that passes Luhn where a context word stands nearby, so that
  adjacent numbers are not lost. Of overlapping runs a single group goes first,
  then the more usual length (``CARD_LENGTHS``), then the leftmost;
- ``ssn``: ddd-dd-dddd only with a context word nearby;
- ``secret``: a private-key block; a key with a known prefix; a long hexadecimal or
  base-64 value that is assigned to a name (``token = "..."``), where its letters are
  as mixed as random ones and a context word stands nearby.

All patterns run in linear time: each starts only where a run of its characters
starts, and quantifiers are possessive where nothing behind them can give back.

Defined results: null and empty texts have no spans; offsets are code points,
the end exclusive; repeated rows each get their own result.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbwise.llm.batches import arrow_pass, ship_package, texts

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "secret")
THRESHOLD = 0.5
#: Characters before and after a span in which context words count.
CONTEXT = 48

# Context words, and how far each moves a score.
CONTEXT_WORDS = {
    "card": ("card", "visa", "mastercard", "amex", "credit", "debit", "payment", "karte", "carte", "tarjeta"),
    "ssn": ("ssn", "social security", "security number"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "secret": ("token", "secret", "passw", "api", "key", "auth", "credential", "bearer", "private"),
}
AGAINST_WORDS = ("isbn", "order no", "serial", "version", "tracking")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = re.compile("[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?= ?[A-Z0-9])")
_IBAN_REST = re.compile(r"(?: ?[A-Z0-9]){1,30}")
_GROUP_END = re.compile(r"[A-Z0-9](?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_DIGITS = re.compile("[0-9]++")
_KEY_BLOCK = re.compile(r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END [A-Z ]{0,40}PRIVATE KEY-----)?")
_ASSIGNED = re.compile(r"""[=:]\s?["']?([A-Za-z0-9+/_-]{20,}+={0,2})""")

# What keys of common services start with, and how many more characters they have at least.
KEY_PREFIXES = (
    ("AKIA", 16), ("ASIA", 16), ("ghp_", 30), ("gho_", 30), ("ghs_", 30), ("github_pat_", 30), ("glpat-", 20),
    ("xoxb-", 20), ("xoxp-", 20), ("sk_live_", 20), ("rk_live_", 20), ("AIza", 30), ("sk-", 32),
)
_PREFIXED = re.compile(
    "(?<![A-Za-z0-9_-])(?:" + "|".join(f"{re.escape(p)}[A-Za-z0-9_-]{{{n},}}+" for p, n in KEY_PREFIXES) + ")"
)
#: Bits of a character from which a value counts as random: of hexadecimal digits, and of any others.
RANDOM_HEX, RANDOM_ANY = 3.0, 3.7

#: Digits of a card, the more usual numbers first.
CARD_LENGTHS = (16, 15, 14, 19, 13, 18, 17)
#: Characters of an IBAN by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28,
    "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18,
    "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22,
    "IL": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LI": 21, "LT": 20, "LU": 20, "LV": 21,
    "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28,
    "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TN": 24,
    "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}

Span = tuple[str, int, int, float]


def luhn(digits: str) -> bool:
    double = sum(divmod(2 * int(d), 10)[0] + divmod(2 * int(d), 10)[1] for d in digits[-2::-2])
    return (double + sum(map(int, digits[-1::-2]))) % 10 == 0


def mod97(code: str) -> bool:
    turned = code[4:] + code[:4]
    remainder = 0
    for char in turned:
        value = int(char, 36)
        remainder = (remainder * (100 if value > 9 else 10) + value) % 97
    return remainder == 1


def digits_of(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each @ outwards so that long runs stay linear."""
    found, floor, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end()))
            floor = domain.end()
        else:
            floor = at + 1
        at = text.find("@", floor)
    return found


def _octets(text: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0")[:3] or "0") <= 255 for part in text.split("."))


def base_spans(text: str) -> list[Span]:
    """The four base kinds, by kind and then start."""
    spans: list[Span] = [("email", a, b, 1.0) for a, b in emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return spans
    spans += [("ip", m.start(), m.end(), 1.0) for m in _IP.finditer(text) if _octets(m[0])]
    for m in _CARD.finditer(text):
        digits = digits_of(m[0]) if m.end() - m.start() <= 40 else ""
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", m.start(), m.end(), 1.0))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(digits_of(m[0])) <= 15:
                spans.append(("phone", m.start(), m.end(), 1.0))
    return spans


def context_score(text: str, start: int, end: int, kind: str, prior: float) -> float:
    around = text[max(0, start - CONTEXT):end + CONTEXT].lower()
    score = prior + 0.4 * any(word in around for word in CONTEXT_WORDS[kind])
    return max(0.0, min(1.0, score - 0.4 * any(word in around for word in AGAINST_WORDS)))


def cards_within(text: str, start: int, end: int) -> list[Span]:
    """Runs of whole digit groups of a row that are cards by length, Luhn and context, none overlapping."""
    groups = [(m.start(), m.end()) for m in _DIGITS.finditer(text, start, end)]
    choices = []
    for first in range(len(groups)):
        digits = ""
        for last in range(first, len(groups)):
            a, b = groups[last]
            if len(digits) + b - a > 19:
                break
            digits += text[a:b]
            if len(digits) >= 13 and luhn(digits):
                at, to = groups[first][0], b
                score = context_score(text, at, to, "card", 0.3)
                if score >= THRESHOLD:
                    choices.append((last > first, CARD_LENGTHS.index(len(digits)), first, last, score))
    taken, kept = set(), []
    for _, _, first, last, score in sorted(choices):
        if taken.isdisjoint(range(first, last + 1)):
            taken.update(range(first, last + 1))
            kept.append(("card", groups[first][0], groups[last][1], score))
    return kept


def ibans(text: str) -> list[tuple[int, int]]:
    """Spans that pass mod-97 at a group end; the search goes on right after each."""
    found, floor = [], 0
    for m in _IBAN.finditer(text):
        if m.start() < floor:
            continue
        stop = _IBAN_REST.match(text, m.end()).end()
        good = {}
        for last in _GROUP_END.finditer(text, m.end()):
            if last.end() > stop:
                break
            code = text[m.start():last.end()].replace(" ", "")
            if 15 <= len(code) <= 34 and mod97(code):
                good[len(code)] = last.end()
        if good:
            floor = good.get(IBAN_LENGTHS.get(m[0][:2]), max(good.values()))
            found.append((m.start(), floor))
    return found


def entropy(value: str) -> float:
    """Bits per character by the characters' own shares."""
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())


def secrets(text: str) -> list[Span]:
    """Key blocks, keys of known prefixes and assigned random values, none overlapping an earlier one."""
    found: list[Span] = [("secret", m.start(), m.end(), 1.0) for m in _KEY_BLOCK.finditer(text)] if "-----BEGIN" in text else []
    taken = [(a, b) for _, a, b, _ in found]
    matches = [(m.start(), m.end(), 1.0) for m in _PREFIXED.finditer(text)]
    for m in _ASSIGNED.finditer(text):
        value = m[1]
        is_hex = not value.strip("0123456789abcdefABCDEF")
        mixed = any(c.isdigit() for c in value) and any(c.isalpha() for c in value)
        if mixed and entropy(value) >= (RANDOM_HEX if is_hex else RANDOM_ANY):
            matches.append((m.start(1), m.end(1), context_score(text, m.start(1), m.end(1), "secret", 0.3)))
    for start, end, score in matches:
        if all(end <= a or b <= start for a, b in taken):
            taken.append((start, end))
            found.append(("secret", start, end, score))
    return found


def added_spans(text: str, base: list[Span]) -> list[Span]:
    """Spans beyond the base kinds whose score reaches the threshold."""
    if not _DIGIT.search(text):
        return [("secret", m.start(), m.end(), 1.0) for m in _KEY_BLOCK.finditer(text)] if "-----BEGIN" in text else []
    cards = {(a, b) for kind, a, b, _ in base if kind == "card"}
    found: list[Span] = []
    for m in _CARD.finditer(text):
        if (m.start(), m.end()) not in cards:
            found += cards_within(text, m.start(), m.end())
    for start, end in ibans(text):
        found.append(("iban", start, end, context_score(text, start, end, "iban", 0.8)))
    for m in _SSN.finditer(text):
        found.append(("ssn", m.start(), m.end(), context_score(text, m.start(), m.end(), "ssn", 0.2)))
    found += secrets(text)
    return [span for span in found if span[3] >= THRESHOLD]


def find_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans ordered by kind and start."""
    base = base_spans(text)
    order = {kind: place for place, kind in enumerate(KINDS)}
    return base, sorted(base + added_spans(text, base), key=lambda s: (order[s[0]], s[1], s[2]))


def redact_text(text: str, spans: list[Span]) -> str:
    """The text with each outermost span replaced by its kind in brackets."""
    parts, at = [], 0
    for kind, start, end, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start < at:
            at = max(at, end)  # overlapping: covered by the earlier mark
            continue
        parts += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*parts, text[at:]])


SPANS = "array<struct<kind:string,start:int,end:int,score:double,base:boolean>>"


def detect(docs: DataFrame, text: str = "text", redacted: str | None = None, drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with a column ``spans``; with ``redacted`` also the text without them. No shuffle."""
    ship_package(docs.sparkSession)
    struct = pa.list_(pa.struct([
        ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("base", pa.bool_()),
    ]))

    def make():
        def compute(part: pa.RecordBatch) -> list:
            rows, clean = [], []
            for value in texts(part, text):
                base, spans = find_spans(value)
                known = set(base)
                rows.append([
                    {"kind": k, "start": a, "end": b, "score": s, "base": (k, a, b, s) in known} for k, a, b, s in spans
                ])
                clean.append(redact_text(value, spans) if redacted and spans else value)
            return [pa.array(rows, struct)] + ([pa.array(clean, pa.string())] if redacted else [])

        return compute

    added = f"spans {SPANS}" + (f", `{redacted}` string" if redacted else "")
    return arrow_pass(docs, added, make, drop)


def digest(detected: DataFrame) -> DataFrame:
    """Counts of the base kinds, a hash of the base spans, and all spans as text."""
    base = F.filter("spans", lambda s: s["base"])
    written = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    ), ",")
    kinds = F.transform(base, lambda s: s["kind"])
    counts = {
        f"n_{kind}": (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("bigint") for kind in BASE_KINDS
    }
    return detected.select(
        "doc_id", *[column.alias(name) for name, column in counts.items()],
        F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"),
    )
