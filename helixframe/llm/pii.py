"""Personal data: regular expressions propose spans, checksums confirm them, context scores them.

Base kinds (email, ip, card, phone) follow fixed patterns, leftmost and without overlap within
a kind; a match that fails its check (parts over 255, digit counts, Luhn) is dropped without a
second try. Further kinds: iban (mod-97 over the length of its country; where the country is not in
``IBAN_LENGTH``, over the longest run of whole words that holds), key (access keys and tokens of
well-known form), ssn (checked number groups) and secret (runs of 20 to 200 letters and digits, with
both, that only context makes one). A span's score starts at its kind's value, rises where a word of
its context stands within ``NEAR`` characters before or after it and falls where a denying word does; base
spans stay whatever their score, spans of further kinds need ``LEAST``: a key or an IBAN in a sample, or a
number group like a social security number without its context, is none.

All offsets are code points. Matching is linear in the text: runs are entered once, at their
first character, so that very long runs of digits or letters cost no more than others.

Edge cases: null text counts as empty and has no spans; repeated rows give repeated results;
an empty table gives an empty result; other columns are neither read nor changed.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, table

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "key", "ssn", "secret")
NEAR = 40
LEAST = 0.5
#: Score of a confirmed span without context.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.9, "phone": 0.7, "iban": 0.7, "key": 0.7, "ssn": 0.3, "secret": 0.3}
#: Words that make a kind likelier, and words that make any kind unlikelier.
CONTEXT = {
    "email": ("mail", "contact", "write"), "ip": ("ip", "address", "server", "host"), "card": ("card", "visa", "credit", "pay"),
    "phone": ("phone", "tel", "call", "mobile", "fax"), "iban": ("iban", "account", "bank"),
    "key": ("key", "token", "secret", "aws"), "ssn": ("ssn", "social", "security"),
    "secret": ("key", "apikey", "token", "secret", "password", "passwd", "pwd", "bearer", "credential", "auth"),
}
DENY = ("example", "version", "isbn", "sample")
#: Characters of an IBAN by country (ISO 13616).
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27,
    "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HN": 28, "HR": 21, "HU": 28,
    "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22,
    "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28, "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24,
    "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SO": 23, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20, "YE": 30,
}
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=((?: ?[A-Z0-9]){11,30}))")
_WORD_END = re.compile(r"[A-Z0-9](?![A-Za-z0-9])")
_KEY = re.compile(r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,64}|xox[abpr]-[A-Za-z0-9-]{10,72})(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_SECRET = re.compile(r"(?<![A-Za-z0-9_+/.-])[A-Za-z0-9_+/-]{20,200}(?![A-Za-z0-9_+/-])")
_SECRET_WORDS = re.compile("|".join(CONTEXT["secret"]))
_DIGIT = re.compile("[0-9]")
#: A word of a sentence, no part of an address or a host name.
_CONTEXT_WORD = re.compile(r"(?<![a-z0-9@.-])[a-z]+(?![a-z0-9@-]|\.[a-z0-9])")
_LETTER = re.compile("[A-Za-z]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = 2 * n - 9 if n > 4 else 2 * n
        total += n
    return total % 10 == 0


def mod97(iban: str) -> bool:
    s = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def ibans(text: str) -> list[tuple[int, int]]:
    """Spans of IBANs, leftmost and without overlap: every head is tried, whatever failed before it."""
    out, last = [], 0
    for m in _IBAN.finditer(text):
        a, want = m.start(), IBAN_LENGTH.get(m[0][:2])
        if a < last:
            continue
        ends = [w.end() for w in _WORD_END.finditer(text, m.end(), m.end(1) + 1) if w.end() <= m.end(1)]
        length = {e: e - a - text.count(" ", a, e) for e in ends}
        for e in reversed(ends):
            if (length[e] == want if want else length[e] >= 15) and mod97(text[a:e]):
                out.append((a, e))
                last = e
                break
    return out


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of the email pattern, found from each ``@`` outwards: the local part is the run of
    its characters before the sign, not before the end of the last match."""
    out, last, at = [], 0, text.find("@")
    floor = 0  # a run that failed at an earlier sign ends there
    while at >= 0:
        i = at
        low = max(last, floor)
        while i > low and text[i - 1] in LOCAL:
            i -= 1
        m = _DOMAIN.match(text, at + 1) if i < at else None
        if m:
            out.append((i, m.end()))
            last = m.end()
        floor = at + 1
        at = text.find("@", max(at + 1, last))
    return out


def _number_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in BASE}
    if "@" in text:
        found["email"] = emails(text)
    if _DIGIT.search(text):
        if "." in text:
            found["ip"] = [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.groups())]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13 and 13 <= len(d := _number_of(m[0])) <= 19 and luhn(d):
                found["card"].append(m.span())
        if "+" in text:
            found["phone"] = [m.span() for m in _PHONE.finditer(text) if 9 <= len(_number_of(m[0])) <= 15]
    return found


def score(kind: str, text: str, start: int, end: int) -> float:
    around = f"{text[max(0, start - NEAR) : start]} {text[end : end + NEAR]}".lower()
    words = set(_CONTEXT_WORD.findall(around))
    s = PRIOR[kind] + 0.3 * any(w in words for w in CONTEXT[kind]) - 0.3 * any(w in words for w in DENY)
    return round(min(1.0, max(0.0, s)), 2)


def all_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of all kinds, in order of KINDS and start; base spans as they are."""
    found = base_spans(text)
    more: dict[str, list[tuple[int, int]]] = {"iban": [], "key": [], "ssn": [], "secret": []}
    if _DIGIT.search(text):
        more["iban"] = ibans(text)
        more["ssn"] = [m.span() for m in _SSN.finditer(text) if m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000"]
    more["key"] = [m.span() for m in _KEY.finditer(text)] if ("AKIA" in text or "_" in text or "-" in text) else []
    if _SECRET_WORDS.search(text.lower()):
        known = set(more["key"])
        more["secret"] = [m.span() for m in _SECRET.finditer(text) if _DIGIT.search(m[0]) and _LETTER.search(m[0]) and m.span() not in known]
    return found | {k: [s for s in v if score(k, text, *s) >= LEAST] for k, v in more.items()}


def redact(text: str) -> str:
    """Spans of any kind replaced by ``[KIND]``; overlapping spans go as one, named by the first, then longest."""
    spans = sorted((a, -b, KINDS.index(k)) for k, v in all_spans(text).items() for a, b in v)
    out, last = [], 0
    for a, b, k in spans:
        if a >= last:
            out += [text[last:a], f"[{KINDS[k].upper()}]"]
        last = max(last, -b)
    return "".join([*out, text[last:]])


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, spans (array of kind, start, end, score) for every document."""
    schema = "doc_id bigint, spans array<struct<kind:string,start:int,end:int,score:double>>"

    def run(batches):
        for b in slices(batches):
            rows = []
            for t in b.column(1).to_pylist():
                t = t or ""
                rows.append([{"kind": k, "start": x, "end": y, "score": score(k, t, x, y)} for k, v in all_spans(t).items() for x, y in v])
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, kind)], ["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, schema)


def redact_documents(docs: DataFrame) -> DataFrame:
    """The documents with personal data replaced, ``n_chars`` made anew; null text stays null."""

    def run(batches):
        for b in slices(batches):
            at, n = b.schema.get_field_index("text"), b.schema.get_field_index("n_chars")
            texts = [None if t is None else redact(t) for t in b.column(at).to_pylist()]
            b = b.set_column(at, b.schema.field(at), pa.array(texts, b.schema.field(at).type))
            if n >= 0:
                b = b.set_column(n, b.schema.field(n), pa.array([None if t is None else len(t) for t in texts], b.schema.field(n).type))
            yield b

    return docs.mapInArrow(run, docs.schema)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    scores = F.array_join(F.transform("spans", lambda s: F.format_string("%.2f", s["score"])), ",")
    return found.select(
        "doc_id",
        *[count(k) for k in BASE],
        F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"), scores.alias("scores"),
    )
