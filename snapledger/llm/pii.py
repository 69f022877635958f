"""Personal data: patterns propose spans, checksums confirm them, context words nearby adjust their score.

Base kinds are email, ip, card (Luhn) and phone. The method adds iban (mod-97), ssn and tel, which need a checksum, or a
context word nearby, to be taken.
"""

from __future__ import annotations

import re
from bisect import bisect_right

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.llm.batches import over_batches, texts_of
from snapledger.llm.spans import FOUND, found_array, ordered

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "tel")

#: The part of an address from its @ on; what stands before is read backwards, so that a long run of letters costs no search.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]*\Z")
#: A run of digits is tried from its beginning only: from within it, the rest would be the same.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_TEL = re.compile(r"(?<![0-9(+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.\x20])[0-9]{3}[-.\x20][0-9]{4}(?![0-9])")

#: Score without context, score added by one of the context words within WINDOW characters, and the words.
CONTEXT = {
    "email": (0.9, 0.1, ("mail", "contact", "write")),
    "ip": (0.6, 0.3, ("ip", "address", "host", "server", "login")),
    "card": (0.7, 0.3, ("card", "visa", "master", "credit", "debit", "payment")),
    "phone": (0.8, 0.2, ("phone", "call", "tel", "mobile", "fax")),
    "iban": (0.8, 0.2, ("iban", "account", "bank", "konto", "compte", "cuenta")),
    "ssn": (0.3, 0.5, ("ssn", "social", "security", "taxpayer")),
    "tel": (0.3, 0.4, ("phone", "call", "tel", "mobile", "fax", "contact")),
}
WINDOW = 40
LEAST = 0.5
_WORDS = {k: re.compile("|".join(rf"\b{w}" for w in v[2]), re.I) for k, v in CONTEXT.items()}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Whether the characters, the first four moved to the end and letters as 10 to 35, leave 1 when divided by 97."""
    plain = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> list[tuple[int, int]]:
    found, past = [], 0
    for m in _DOMAIN.finditer(text):
        at = m.start()
        start = at
        while start > past:  # in steps, so that a long local part is read once
            step = max(past, start - 64)
            run = _LOCAL_END.search(text, step, start)
            grown = run.start() if run else start
            if grown > step:
                start = grown
                break
            start = step
        if start < at:
            found.append((start, m.end()))
            past = m.end()
    return found


def _ibans(text: str) -> list[tuple[int, int]]:
    """Numbers that mod-97 confirms: of the groups from a beginning, as many as it does; the words after one may look like groups."""
    found, at = [], 0
    while m := _IBAN.search(text, at):
        at, run = m.start() + 1, m[0]
        while 15 <= len(run.replace(" ", "")):
            if len(run.replace(" ", "")) <= 34 and mod97(run):
                at = m.start() + len(run)
                found.append((m.start(), at))
                break
            run = run.rpartition(" ")[0]
    return found


def _ip_part(part: str) -> bool:
    short = part.lstrip("0") or "0"
    return len(short) <= 3 and int(short) <= 255


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("email", s, e) for s, e in _emails(text)] if "@" in text else []
    found += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(map(_ip_part, m[0].split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return found


def more_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("iban", s, e) for s, e in _ibans(text)]
    found += [("ssn", m.start(), m.end()) for m in _SSN.finditer(text)]
    return found + [("tel", m.start(), m.end()) for m in _TEL.finditer(text)]


def score(text: str, kind: str, start: int, end: int) -> float:
    prior, gain, _ = CONTEXT[kind]
    near = _WORDS[kind].search(text, max(0, start - WINDOW), start) or _WORDS[kind].search(text, end, end + WINDOW)
    return round(prior + gain * bool(near), 6)


def scan_text(text: str) -> list[tuple]:
    """All base spans, and the further spans that score LEAST or more and overlap no base span."""
    base = base_spans(text)
    found = [(k, s, e, score(text, k, s, e)) for k, s, e in base]
    starts, ends = [], []  # of what base spans cover together
    for s, e in sorted((s, e) for _, s, e in base):
        if ends and s < ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    for k, s, e in more_spans(text):
        at = bisect_right(ends, s)
        free = at == len(starts) or starts[at] >= e
        if free and (value := score(text, k, s, e)) >= LEAST:
            found.append((k, s, e, value))
    return ordered(found, KINDS)


def find_pii(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id`` and ``found``, all spans in code points with a score.

    A null or empty text has none; repeated rows are each answered; a null id stays null; other columns are left out; an
    empty table gives no rows. One pass over each text without a shuffle.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([batch.column(0), found_array([scan_text(t) for t in batch.column(1).to_pylist()])], ["doc_id", "found"])

    return over_batches(texts_of(df, id_col, text_col), work, f"doc_id long, found {FOUND}")


def mask_text(text: str) -> str:
    """``text`` with each span, or run of overlapping spans, as the name of its first kind in brackets."""
    parts, past = [], 0
    for kind, start, end, _ in scan_text(text):
        if start >= past:
            parts += [text[past:start], f"[{kind.upper()}]"]
        past = max(past, end)
    return "".join(parts) + text[past:] if parts else text


def _masked(texts: pd.Series) -> pd.Series:
    return texts.map(mask_text, na_action="ignore")


def masked(text: Column) -> Column:
    """The text with its personal data replaced by placeholders; null stays null."""
    return F.pandas_udf(_masked, "string")(text)
