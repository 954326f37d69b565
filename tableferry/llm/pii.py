"""Personal data: expressions propose spans, checks confirm them, nearby words set their score.

The base kinds (email, ip, card, phone) are found by fixed rules and always stay. The further
kinds are proposed more loosely: an account number counts once its check digits are right, a
national number or a phone number without country code only where the words around speak of
one. Every span has a score; further spans below :data:`LEAST` or over another span are dropped.

Defined results: a null text counts as empty and has no spans. Positions are code points, the end
exclusive. Texts are searched whole, in time that grows with their length (no expression here
starts over inside a run that it has read). Rows do not see each other, so repeated rows give
repeated results. Other columns are kept; one named like a new column (in any case) is replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tableferry.llm.common import extended

# The kinds of the contract in their order, then the further ones.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "national_id", "local_phone")

#: Further spans need this score, and context is looked for so many code points away.
LEAST, AROUND = 0.5, 48

# Expressions. A local part is the run of its characters in front of an @.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
AT_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9]++(?:[\x20-][0-9]++)*+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])([A-Z]{2})[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
NATIONAL_ID = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
LOCAL_PHONE = re.compile(r"(?<![0-9+(])\(?0?[0-9]{2,4}\)?[\x20/-][0-9]{3}[\x20-]?[0-9]{4}(?![0-9])")

# Lengths of account numbers by country.
IBAN_LENGTH = {"AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18,
               "EE": 20, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28,
               "IE": 22, "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27,
               "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SI": 19,
               "SK": 24, "SM": 27, "TR": 26}

# Words that speak for a kind, and words that speak against any.
SPEAKS_FOR = {
    "email": "email e-mail mail contact kontakt correo courriel",
    "ip": "ip address host server adresse dirección",
    "card": "card credit visa mastercard karte kreditkarte carte tarjeta",
    "phone": "phone tel call mobile telefon anruf téléphone teléfono fax",
    "iban": "iban account bank konto compte cuenta",
    "national_id": "ssn social security insurance sozialversicherung sécurité seguridad",
    "local_phone": "phone tel call mobile telefon anruf téléphone teléfono fax",
}
SPEAKS_AGAINST = "version isbn order invoice ticket serial bestellung rechnung commande factura"

# Scores without context, confirmed by a check or not, and what a word changes.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "national_id": 0.3,
         "local_phone": 0.3}
WORD_FOR, WORD_AGAINST = 0.3, 0.3

SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())]))

Span = tuple[str, int, int, float]


def luhn(digits: str) -> bool:
    """Whether the last digit is the check digit of the others."""
    odd = sum(map(int, digits[-1::-2]))
    even = sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))
    return (odd + even) % 10 == 0


def mod_97(number: str) -> bool:
    """Whether the check digits of an account number are right."""
    moved = number[4:] + number[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The local part goes back from the @ to the first character that it cannot hold, but not
    into the address before."""
    last = 0
    for m in AT_DOMAIN.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            last = m.end()
            yield start, last


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base kinds, by start and then kind."""
    found = [("email", *s) for s in _emails(text)]
    found += [("ip", *m.span()) for m in IP.finditer(text)
              if all(map(_small, m.group().split(".")))]
    for m in CARD.finditer(text):
        if 12 <= m.end() - m.start():
            digits = _digits(m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    found += [("phone", *m.span()) for m in PHONE.finditer(text)
              if 9 <= len(_digits(m.group())) <= 15]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    for m in IBAN.finditer(text):
        left, end = IBAN_LENGTH.get(m.group(1), 0), m.start()
        number = []
        while end < m.end() and len(number) < left:
            if text[end] != " ":
                number.append(text[end])
            end += 1
        whole = end == len(text) or not (text[end].isascii() and text[end].isalnum())
        if left and len(number) == left and whole and mod_97("".join(number)):
            yield m.start(), end


def _ids(text: str) -> Iterator[tuple[int, int]]:
    for m in NATIONAL_ID.finditer(text):
        area, group, serial = m.group().split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield m.span()


def _word_pattern(words: str) -> re.Pattern:
    return re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, words.split())) + r")(?!\w)",
                      re.IGNORECASE)


class Finder:
    """Spans of whole texts with their scores."""

    def __init__(self, least: float = LEAST, around: int = AROUND):
        self.least, self.around = least, around
        self.fors = {k: _word_pattern(w) for k, w in SPEAKS_FOR.items()}
        self.against = _word_pattern(SPEAKS_AGAINST)

    def score(self, text: str, kind: str, start: int, end: int) -> float:
        near = f"{text[max(start - self.around, 0):start]} {text[end:end + self.around]}"
        out = PRIOR[kind]
        if self.fors[kind].search(near):
            out += WORD_FOR
        if self.against.search(near):
            out -= WORD_AGAINST
        return round(min(max(out, 0.0), 1.0), 6)

    def spans(self, text: str) -> list[Span]:
        """All spans by start and then kind; further ones touch neither base spans nor each
        other."""
        kept = [(*s, self.score(text, *s)) for s in base_spans(text)]
        more = [("iban", *s) for s in _ibans(text)]
        more += [("national_id", *s) for s in _ids(text)]
        more += [("local_phone", *m.span()) for m in LOCAL_PHONE.finditer(text)]
        if more:
            scored = sorted(((*s, self.score(text, *s)) for s in more),
                            key=lambda s: (-s[3], s[1], KINDS.index(s[0])))
            taken = Taken(kept)
            kept += [s for s in scored if s[3] >= self.least and taken.add(s[1], s[2])]
        return sorted(kept, key=lambda s: (s[1], KINDS.index(s[0])))


class Taken:
    """Places that spans hold, as disjoint intervals in order."""

    def __init__(self, spans: list[Span]):
        self.starts, self.ends = [], []
        for _, start, end, _ in spans:
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def add(self, start: int, end: int) -> bool:
        """Take a place if nothing in it is taken yet."""
        i = bisect_right(self.ends, start)
        if i < len(self.starts) and self.starts[i] < end:
            return False
        self.starts.insert(i, start)
        self.ends.insert(i, end)
        return True


def masked(text: str, spans: list[Span]) -> str:
    """The text with the name of the kind in place of each span; of spans that overlap, the
    union gets the name of the first."""
    out, at = [], 0
    for kind, start, end, _ in spans:
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def found(df: DataFrame, text: str = "text", least: float = LEAST, around: int = AROUND,
          mask: str | None = None) -> DataFrame:
    """``df`` with ``spans``, an array of kind, start, end and score, and with the masked text in
    the column ``mask`` if one is named."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()),
                               ("end", pa.int64()), ("score", pa.float64())]))
    fields = [T.StructField("spans", SPANS)]
    if mask:
        fields.append(T.StructField(mask, T.StringType()))

    def make():
        finder = Finder(least, around)

        def work(texts: list[str]) -> list[pa.Array]:
            all_spans = [finder.spans(t) for t in texts]
            out = [pa.array([[dict(zip(("kind", "start", "end", "score"), s)) for s in spans]
                             for spans in all_spans], kind)]
            if mask:
                out.append(pa.array(list(map(masked, texts, all_spans)), pa.string()))
            return out

        return work

    return extended(df, fields, make, text)


def listed(spans: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
