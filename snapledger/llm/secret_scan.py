"""Secret scan by assignment-aware lexing.

A lexer reads name-literal pairs (``name = "literal"``, ``name: literal``, ``"name": "literal"``) as source code and
configuration files write them. A right side may also be a name read before or a sum of names and literals; such constants
are propagated, so that a literal bound to ``a`` counts for ``b`` after ``b = a``. A literal is scored by how sensitive the
name is that it reaches, and by its own length and variety. Three plain patterns (assign, access, hex) stand beside it.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame

from snapledger.llm.batches import over_batches, texts_of
from snapledger.llm.spans import FOUND, found_array, ordered

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "literal")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_LONG_HEX = re.compile(r"[0-9a-f]{32}")

_NAME = r"[A-Za-z_][A-Za-z0-9_.-]*+"
_STRING = r"\"(?:[^\"\\\n]|\\.)*+\"|'(?:[^'\\\n]|\\.)*+'"
#: A name that begins a run of name characters, an assignment sign, then where the right side begins.
_PAIR = re.compile(rf"""(?<![A-Za-z0-9_.-])({_NAME})["']?[\x20\t]*(?::=|=>|=(?!=)|:(?!:|//))[\x20\t]*(?=\S)""")
_TERM = re.compile(rf"""({_STRING})|([^\s,;"'(){{}}\[\]<>|&+#*%$]++)""")
#: The unquoted value of a line that is one setting: up to white space, then nothing or a comment.
_VALUE = re.compile(r"""(?![\"'])(\S++)(?=[\x20\t\r]*$|[\x20\t]+[#;])""", re.M)
_LEAD = re.compile(r"[\x20\t]*+(?:export[\x20\t]++)?+")
_WHOLE_NAME = re.compile(_NAME)
#: An element that holds nothing but text.
_ELEMENT = re.compile(rf"<({_NAME})>([^<>\n]++)</({_NAME})>")
_REFERENCE = re.compile(r"\$(?:\w+$|\{.*\}$|\()|%\w+%$|[\w.]+[(\[].*[)\]];?$")
_PLUS = re.compile(r"[\x20\t]*\+[\x20\t]*")

#: How much a part of a name says that its literal is secret.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0, "api_key": 1.0,
    "access_key": 1.0, "private_key": 1.0, "secret_key": 1.0, "auth": 0.6, "credential": 0.9, "credentials": 0.9, "bearer": 0.8,
    "signing_key": 0.9, "encryption_key": 0.9, "client_secret": 1.0, "key": 0.5, "pass": 0.8,
}
#: Words that count also at the end of a longer one.
_ENDINGS = ("password", "passwd", "passphrase", "secret", "token", "apikey", "mypass", "dbpass", "userpass")
_BREAK = re.compile(r"[_.\-]+|(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])")
_PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|\.+|none|null|true|false|changeme|example|your[_-].*|<.*>|\$\{.*\})$")


def _part_weight(part: str) -> float:
    single = part.removesuffix("s")
    return SENSITIVE.get(part) or SENSITIVE.get(single) or (0.9 if part.endswith(_ENDINGS) or single.endswith(_ENDINGS) else 0.0)


def name_weight(name: str) -> float:
    """The largest weight of a part of ``name``, or of two neighbouring parts together; plurals count as their singular."""
    parts = [p.lower() for p in _BREAK.split(name) if p]
    pairs = [f"{a}_{b}" for a, b in zip(parts, parts[1:], strict=False)]
    return max((*map(_part_weight, parts), *(SENSITIVE.get(p, 0.0) for p in pairs)), default=0.0)


class Chain:
    """Literals that are read one after another: a leaf with its place, or earlier chains together.

    It keeps how often each character stands in it, not the text, so that a constant that grows line by line costs the same
    each time. ``score`` is the best that a name reached by it has given.
    """

    __slots__ = ("children", "place", "counts", "length", "head", "last", "score")

    def __init__(self, children, place, counts, length, head, last):
        self.children, self.place, self.counts, self.length, self.head, self.last, self.score = children, place, counts, length, head, last, 0.0

    def weight(self) -> float:
        """0 for a short word or placeholder, towards 1 for long and varied text (entropy of its characters)."""
        n = self.length
        if n < 6 or self._placeholder():
            return 0.0
        entropy = -sum(c / n * math.log2(c / n) for c in self.counts.values())
        mixed = sum(any(map(kind, self.counts)) for kind in _KINDS)
        return min(1.0, entropy / 4) * (0.5 if mixed < 2 else 1.0) * min(1.0, n / 12)

    def _placeholder(self) -> bool:
        if self.length <= HEAD:
            return bool(_PLACEHOLDER.match(self.head))
        kinds = set(self.counts)
        closed = (self.head[0] == "<" and self.last == ">") or (self.head.startswith("${") and self.last == "}")
        return kinds <= {"x", "X"} or kinds == {"*"} or kinds == {"."} or "\n" not in kinds and (closed or self.head[:5].lower() in ("your_", "your-"))


HEAD = 64
_KINDS = (lambda c: "a" <= c <= "z", lambda c: "A" <= c <= "Z", lambda c: "0" <= c <= "9", lambda c: not (c.isascii() and c.isalnum()))


def _leaf(start: int, value: str, counts: Counter | None = None) -> Chain:
    return Chain((), (start, start + len(value)), counts or Counter(value), len(value), value[:HEAD], value[-1:])


def _joined(a: Chain, b: Chain) -> Chain:
    counts = dict(a.counts)
    for c, n in b.counts.items():
        counts[c] = counts.get(c, 0) + n
    return Chain((a, b), None, counts, a.length + b.length, (a.head + b.head)[:HEAD] if a.length < HEAD else a.head, b.last or a.last)


def literal_weight(value: str) -> float:
    return _leaf(0, value).weight()


def base_spans(text: str) -> list[tuple]:
    found = [("assign", m.start(), m.end(), 1.0) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [("access", m.start(), m.end(), 1.0) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    if _LONG_HEX.search(text):
        found += [("hex", m.start(), m.end(), 1.0) for m in _HEX.finditer(text) if m.end() - m.start() >= 32]
    return found


class _Reader:
    """Right sides of pairs from left to right; what several pairs have in common, a run or the sum behind it, is read once."""

    def __init__(self, text: str):
        self.text, self.made = text, []
        self.constants: dict[str, Chain] = {}
        self.sums: dict[int, tuple[Chain | None, bool, bool]] = {}
        self.begin = self.end = self.stop = 0  # the last run of plain characters, and its end without dots
        self.counted, self.counts = -1, Counter()
        self.line, self.seen, self.lead = 0, 0, -1

    def keep(self, chain: Chain) -> Chain:
        self.made.append(chain)
        return chain

    def plain_end(self, at: int) -> int:
        """Where the run of plain characters that holds ``at`` ends; ``at`` if none does."""
        if not self.begin <= at < self.end:
            term = _TERM.match(self.text, at)
            if not term or term[1]:
                return at
            self.begin, self.end, self.counted = at, term.end(), -1
            self.stop = at + len(term[2].rstrip("."))
        return self.end

    def plain(self, at: int) -> Chain:
        """The rest of the run from ``at``; its characters are counted once for all places in it."""
        if self.counted < 0 or at < self.counted:
            self.counts, self.counted = Counter(self.text[at:self.stop]), at
        elif at > self.counted:
            self.counts.subtract(self.text[self.counted:min(at, self.stop)])
            self.counts = +self.counts
            self.counted = at
        stop = max(at, self.stop)
        return self.keep(Chain((), (at, stop), Counter(self.counts), stop - at, self.text[at:min(stop, at + HEAD)], self.text[stop - 1] if stop > at else ""))

    def right_side(self, at: int, wanted: bool) -> tuple[Chain | None, bool, bool]:
        """The literals from ``at`` on, whether all are strings or constants, and whether any is.

        ``wanted``: also where plain words are among them; without it those give no chain.
        """
        terms, after = [], None
        while True:
            if at in self.sums and terms:
                after = self.sums[at]
                break
            end, plain = self.plain_end(at), True
            if end > at:
                name = _WHOLE_NAME.match(self.text, at, end)
                known = self.constants.get(self.text[at:end]) if name and name.end() == end else None
                terms.append((at, known, known is not None, at))
            else:
                term = _TERM.match(self.text, at)
                if not term:
                    break
                end = term.end()
                terms.append((at, self.keep(_leaf(at + 1, term[1][1:-1])), True, at))
            more = _PLUS.match(self.text, end)
            if not more:
                break
            at = more.end()
        found = after or (None, True, False)
        for k in range(len(terms) - 1, -1, -1):
            start, chain, known, _ = terms[k]
            rest, all_known, any_known = found
            if chain is None and (wanted or k):
                chain = self.keep(self._word(start))
            both = chain if rest is None else rest if chain is None else self.keep(_joined(chain, rest))
            found = (both, all_known and known, any_known or known)
            if k:
                self.sums[start] = found
        return found

    def _word(self, at: int) -> Chain:
        if self.begin <= at < self.end:
            return self.plain(at)
        term = _TERM.match(self.text, at)
        return _leaf(at, term[2].rstrip("."))

    def setting(self, pair: re.Match) -> Chain | None:
        """The whole unquoted value where the line is ``name=value``, and no reference or call."""
        text, start = self.text, pair.start()
        newline = text.rfind("\n", self.seen, start)
        if newline >= 0:
            self.line, self.lead = newline + 1, -1
        self.seen = start
        if self.lead < 0:
            self.lead = _LEAD.match(text, self.line).end()
        if start != self.lead or text[pair.end(1):pair.end()].strip() != "=":
            return None
        value = _VALUE.match(text, pair.end())
        if not value or _REFERENCE.match(value[1]):
            return None
        return self.keep(_leaf(value.start(), value[1].rstrip(".,;")))


def literal_spans(text: str, least: float) -> list[tuple]:
    """Literals that reach a sensitive name, directly or through constants, scored ``least`` or more."""
    reader = _Reader(text)
    for pair in _PAIR.finditer(text) if "=" in text or ":" in text else ():
        weight = name_weight(pair[1])
        chain, plain, known = reader.right_side(pair.end(), weight > 0)
        if not known and weight and (whole := reader.setting(pair)):
            chain, plain = whole, False
        if chain is None:
            continue
        if plain:
            reader.constants[pair[1]] = chain
        if weight:
            chain.score = max(chain.score, weight * chain.weight())
    for element in _ELEMENT.finditer(text) if "</" in text else ():
        weight = name_weight(element[1]) if element[1] == element[3] else 0
        if weight:
            chain = reader.keep(_leaf(element.start(2), element[2]))
            chain.score = weight * chain.weight()
    best: dict[tuple[int, int], float] = {}
    for chain in reversed(reader.made):  # a chain stands behind what it was made of
        if chain.score >= least:
            for child in chain.children:
                child.score = max(child.score, chain.score)
            if chain.place and chain.place[0] < chain.place[1]:
                best[chain.place] = max(best.get(chain.place, 0.0), chain.score)
    return [("literal", s, e, round(v, 6)) for (s, e), v in best.items()]


def scan_text(text: str, least: float = 0.45) -> list[tuple]:
    return ordered(base_spans(text) + literal_spans(text, least), KINDS)


def find_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.45) -> DataFrame:
    """One row per input row: ``doc_id`` and ``found``, all spans in code points with a score.

    A null or empty text has none; repeated rows are each answered; a null id stays null; other columns are left out; an
    empty table gives no rows. One pass over each text without a shuffle.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [scan_text(t, least) for t in batch.column(1).to_pylist()]
        return pa.record_batch([batch.column(0), found_array(rows)], ["doc_id", "found"])

    return over_batches(texts_of(df, id_col, text_col), work, f"doc_id long, found {FOUND}")
