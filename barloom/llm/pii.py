"""Personal data: expressions propose spans, checksums confirm them, words nearby move a score."""

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Span = tuple[str, int, int, float]

#: Kinds in the order of the digest; those after the first four are added by the method.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE = KINDS[:4]

EMAIL_AFTER = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# possessive: nothing follows, so nothing is ever given back, and long runs of digits need no stack
IP = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
IBAN_START = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
#: Characters of an account number by country: fixed values. Other countries may have any length.
IBAN_LENGTHS = {
    country: int(size)
    for size, countries in re.findall(
        r"([0-9]+) ([A-Z ]+)",
        "15 NO 16 BE 18 DK FI FO GL NL SD 19 MK SI 20 AT BA EE KZ LT LU MN XK 21 CH HR LI LV 22 BG BH CR DE GB GE IE ME RS VA "
        "23 AE GI IL IQ OM SO TL 24 AD CZ ES MD PK RO SA SE SK TN VG 25 LY PT ST 26 IS TR 27 BI DJ FR GR IT MC MR SM "
        "28 AL AZ BY CY DO GT HU LB NI PL SV 29 BR EG PS QA UA 30 JO KW MU 31 MT SC 32 LC 33 RU",
    )
    for country in countries.split()
}
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}([-\x20])(?!00)[0-9]{2}\1(?!0000)[0-9]{4}(?![0-9-])")
NOT_DIGIT = re.compile(r"[^0-9]+")

#: What a span of the kind is worth by itself, once its checksum holds.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.5, "iban": 0.8, "ssn": 0.3}
#: Words whose presence nearby speaks for a kind, or against any.
FOR = {
    "email": "mail email contact correo courriel",
    "ip": "ip address host server addr adresse",
    "card": "card credit visa mastercard amex payment karte carte tarjeta",
    "phone": "phone tel telephone call mobile fax telefon telefono",
    "iban": "iban bank account konto compte cuenta bic swift",
    "ssn": "ssn social security sozialversicherung",
}
AGAINST = "version release order invoice isbn part serial model sku id"
CONTEXT = 40  # code points on either side
UP, DOWN = 0.3, 0.2
_against = re.compile(rf"\b(?:{AGAINST.replace(' ', '|')})\b", re.IGNORECASE)
_for = {kind: re.compile(rf"\b(?:{words.replace(' ', '|')})\b", re.IGNORECASE) for kind, words in FOR.items()}


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if place % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def mod97(code: str) -> bool:
    """The check of an account number: letters count 10 to 35, the first four characters go last."""
    remainder = 0
    for char in code[4:] + code[:4]:
        value = int(char, 36)
        remainder = (remainder * (100 if value > 9 else 10) + value) % 97
    return remainder == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """As a search for the whole expression would find them, but started from each `@`: linear in the text."""
    past, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > past and text[start - 1] in LOCAL:
            start -= 1
        found = EMAIL_AFTER.match(text, at + 1) if start < at else None
        if found:
            past = found.end()
            yield start, past
        else:
            past = max(past, at + 1)  # no later local part reaches over this sign
        at = text.find("@", past)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for found in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in found[0].split(".")):
            yield found.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for found in CARD.finditer(text):
        if 12 <= found.end() - found.start():
            digits = NOT_DIGIT.sub("", found[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield found.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for found in PHONE.finditer(text):
        if 9 <= len(NOT_DIGIT.sub("", found[0])) <= 15:
            yield found.span()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Account numbers whose check holds. Words after a number look like a part of it, so a proposal may end at each of its
    blanks: at the country's length, else as a whole, else, for a country without a known length, at the last that holds."""
    at = IBAN_START.search(text)
    while at:
        start, past = at.start(), at.start() + 1
        found = IBAN.match(text, start)
        if found:
            blanks = [i for i in range(start, found.end()) if text[i] == " "]
            ends = [(end, code) for end in (found.end(), *reversed(blanks)) if 15 <= len(code := text[start:end].replace(" ", "")) <= 34]
            size = IBAN_LENGTHS.get(text[start : start + 2])
            if size is not None:
                ends = [e for e in ends if len(e[1]) == size] + [e for e in ends if e[0] == found.end()]
            past = next((end for end, code in ends if mod97(code)), 0)
            if past:
                yield start, past
            past = past or start + 1
        at = IBAN_START.search(text, past)


def _ssns(text: str) -> Iterator[tuple[int, int]]:
    for found in SSN.finditer(text):
        yield found.span()


PROPOSE: dict[str, Callable[[str], Iterator[tuple[int, int]]]] = dict(
    zip(KINDS, (_emails, _ips, _cards, _phones, _ibans, _ssns))
)


def score(text: str, kind: str, start: int, end: int) -> float:
    near = text[max(start - CONTEXT, 0) : start] + " " + text[end : end + CONTEXT]
    value = PRIOR[kind] + UP * bool(_for[kind].search(near)) - DOWN * bool(_against.search(near))
    return round(min(max(value, 0.0), 1.0), 3)


def find(text: str, threshold: float = 0.5) -> list[Span]:
    """(kind, start, end, score) in code points, by start, then kind. Base kinds stay whatever their score; the
    added kinds need ``threshold``, and those without a checksum may not overlap a base span."""
    base = [(kind, *span, score(text, kind, *span)) for kind in BASE for span in PROPOSE[kind](text)]
    taken = [(start, end) for _, start, end, _ in base]
    more = [
        (kind, start, end, worth)
        for kind in KINDS[4:]
        for start, end in PROPOSE[kind](text)
        if (worth := score(text, kind, start, end)) >= threshold and (kind == "iban" or not any(start < b and a < end for a, b in taken))
    ]
    return sorted(base + more, key=lambda span: (span[1], KINDS.index(span[0])))


def redact(text: str, spans: list[Span]) -> str:
    """Each maximal stretch of overlapping spans becomes the name of the first one in square brackets."""
    out, past, until = [], 0, -1
    for kind, start, end, _ in spans:
        if start >= until:
            out += [text[past:start], f"[{kind.upper()}]"]
        until = past = max(until, end)
    return "".join([*out, text[past:]])


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))




def personal_data(
    docs: DataFrame, text: str = "text", threshold: float = 0.5, columns: tuple[str, str] = ("spans", "redacted")
) -> DataFrame:
    """``docs`` with two more columns, named by ``columns`` (columns of these names are replaced): the spans of personal
    data found in the whole text, an array of (kind, start, end, score), and the text with them taken out.

    One pass without a shuffle; a row stays with its task. A null text has no spans and stays null, an empty one has
    none. Repeated rows are treated alike. Offsets count code points, ends are exclusive. Matches of one kind do not
    overlap; those of two kinds may.
    """
    kept = [c for c in docs.columns if c not in columns]
    docs = docs.select(*kept)
    added = f"`{columns[0]}` array<struct<kind:string,start:long,end:long,score:double>>, `{columns[1]}` string"
    schema = T.StructType([*docs.schema.fields, *T.StructType.fromDDL(added).fields])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(kept.index(text)).to_pylist()
            found = [find(x, threshold) if x else [] for x in texts]
            spans = [[{"kind": k, "start": a, "end": b, "score": s} for k, a, b, s in row] for row in found]
            clean = [redact(x, row) if row else x for x, row in zip(texts, found)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(spans, SPANS), pa.array(clean, batch.column(kept.index(text)).type)],
                names=[*kept, *columns],
            )

    return docs.mapInArrow(add, schema)


def digests(found: DataFrame) -> DataFrame:
    """Counts and digests of the spans: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, scores."""
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    base = F.filter("spans", lambda s: s.kind.isin(*BASE))
    count = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *map(count, KINDS), F.sha2(line(base), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"),
        F.array_join(F.transform("spans", lambda s: s.score.cast("string")), ",").alias("scores"),
    )
