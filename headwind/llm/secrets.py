"""Secret scans: base patterns, and assignment-aware lexing of names and literals.

The lexer reads source and configuration syntax, typed and labelled assignments included, into
(name, literal) pairs, follows names that are assigned other names, wherever these are defined, and
scores each literal by the names that it reaches and by its own shape.
Whole texts are read, one at a time; nothing is shuffled.

Spans are kind:start:end in code points, end exclusive. Defined cases: null text is empty and has no
spans; repeated rows are scanned alike; a literal inside a base span is not reported again.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headwind.llm.texts import arrow_pass

Span = tuple[int, str, int]  # start, kind, end

#: fixed values: the base patterns, least lengths, and the order of kinds that start together
KINDS = ("assign", "access", "hex", "literal")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_NAMES = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # whole runs, so the least length can stand in the pattern
_HEX = re.compile(r"[0-9a-f]{16,}")

# a name is looked for once in a run of its characters, from the first letter on
_SIGN = re.compile(r"""(?<![\w.\-])(?:(?![A-Za-z_])[\w.\-])*+(?P<name>[A-Za-z_][\w.\-]*+)["'\]]?[ \t]*(?::=|=>|==?|:)[ \t]*""")
_QUOTED = re.compile(r"""(["'`])([^"'`\n]+)\1""")
_BARE = re.compile(r"""[^\s"'`,;#(){}\[\]<>]+""")
# after a bare value: what is left of a type, and the sign that makes the value a type or a name
_ASSIGNED = re.compile(r"""(?:[ \t]*(?:\[[^\[\]\n=]*(?:\[[^\[\]\n=]*\][^\[\]\n=]*)*\]|<[^<>\n=]*>|\|[ \t]*[\w.]+))*[ \t]*(?::=|=(?![=>]))[ \t]*""")
# a name and its sign at the start of a bare value, which is read again from there
_NAMED = re.compile(r"[A-Za-z_][\w.\-]*[:=]")
# a call or a lookup in place of a value: what it gives is not in the text
_CALL = re.compile(r"[ \t]*[(\[]")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_REFERENCE = re.compile(r"\$?\{?([A-Za-z_][\w.\-]*)\}?")
#: fixed values: parts of names by how sensitive they are
_STRONG = frozenset("password passwd pwd passphrase secret token apikey credential credentials privatekey bearer".split())
_WEAK = frozenset("key auth private access signing encryption session cookie salt signature client master".split())
_PLACEHOLDER = re.compile(r"(?i)(?:true|false|null|none|undefined|x{3,}|\*{3,}|\.{3,})$|example|sample|changeme|your[_-]")
#: least sum of the name's and the literal's scores
THRESHOLD = 3.5


def base_spans(text: str) -> list[tuple[int, str, int, int]]:
    """(start, kind, end, start of the secret itself) of the base patterns."""
    found = []
    low = text.lower()
    if any(n in low for n in _NAMES):
        found += [(m.start(), "assign", m.end(), m.start(2)) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end(), m.start()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), "hex", m.end(), m.start()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[1])))


def name_score(name: str) -> float:
    """2 for a part like `token`, 1 for one like `key`, the two best parts counted."""
    parts = [p.lower() for p in _PARTS.findall(name)]
    joined = {a + b for a, b in zip(parts, parts[1:], strict=False)}
    strong = 2.0 * len((_STRONG & set(parts)) | (_STRONG & joined))
    return min(3.0, strong + len(_WEAK & set(parts)))


def literal_scores(text: str, spans: list[tuple[int, int]]) -> dict[tuple[int, int], float]:
    """Up to 3 for each (start, end): length, mixed kinds of characters, entropy. Placeholders, prose and
    urls score 0.

    Values that end at one place, of which each holds the next, are measured together from the last to
    the first, so that a long chain of names and signs takes no time by its square.
    """
    by_end: dict[int, list[int]] = {}
    for start, end in set(spans):
        by_end.setdefault(end, []).append(start)
    out = {}
    for end, starts in by_end.items():
        n_of: Counter[str] = Counter()
        kinds, plain, url, done = set(), True, False, end
        for start in sorted(starts, reverse=True):
            more = text[start:done]
            n_of.update(more)
            for c in set(more):
                kinds.add("lower" if c.islower() else "upper" if c.isupper() else "digit" if c.isdigit() else "")
                plain &= c.isalnum()
            url = url or text.find("://", start, min(end, done + 2)) >= 0
            done, n = start, end - start
            if n < 8 or url or any(c.isspace() for c in n_of) or _PLACEHOLDER.match(text, start, end):
                out[start, end] = 0.0
                continue
            mixed = len(kinds - {""}) + (not plain)
            entropy = -sum(k / n * math.log2(k / n) for k in n_of.values())
            out[start, end] = min(1.0, n / 16) + (mixed >= 2) * 0.5 + (mixed >= 3) * 0.5 + min(1.0, entropy / 4)
    return out


def pairs(text: str) -> list[tuple[str, str, int, int]]:
    """(name, kind of value, start, end). `a: b = value` gives the value to a, to which b may be a type, and
    to b, to which a may be a label. A bare value that is called, as in `f(x)`, is none.

    Each place of the text is read a bounded number of times: where a bare value ends is known
    beforehand for all places within it.
    """
    found, at = [], 0
    runs = iter(_BARE.finditer(text))
    run = next(runs, None)

    def value_at(place: int) -> tuple[str, int, int] | None:
        """The quoted or bare value that starts there; places only grow."""
        nonlocal run
        if quoted := _QUOTED.match(text, place):
            return ("literal", *quoted.span(2))
        while run and run.end() <= place:
            run = next(runs, None)
        return ("bare", place, run.end()) if run and run.start() <= place else None

    while m := _SIGN.search(text, at):
        value = value_at(m.end())
        if not value:
            at = m.end()
            continue
        kind, start, end = value
        again = kind == "bare" and _NAMED.match(text, start, end)
        at = end + (kind == "literal")
        if kind == "bare" and not again and _CALL.match(text, end) and not _ASSIGNED.match(text, end):
            continue
        found.append((m["name"], *value))
        sign = _ASSIGNED.match(text, end) if kind == "bare" else None
        if sign and (typed := value_at_later(text, sign.end())):
            found.append((m["name"], *typed))
            at = start
        elif again:
            at = start
    return found


def value_at_later(text: str, place: int) -> tuple[str, int, int] | None:
    """As within `pairs`, for a place that will be passed again."""
    if quoted := _QUOTED.match(text, place):
        return ("literal", *quoted.span(2))
    bare = _BARE.match(text, place)
    return ("bare", *bare.span()) if bare else None


def resolved(text: str, found: list[tuple[str, str, int, int]]) -> list[int]:
    """For each pair, the pair whose value it stands for: names are followed to the last definition
    before their use or, without one, to the first after it. A circle ends where it closes."""
    defined: dict[str, list[int]] = {}
    for i, (name, *_) in enumerate(found):
        defined.setdefault(name, []).append(i)
    stands: list[int | None] = [None] * len(found)
    for i in range(len(found)):
        path, at, on = [], i, set()
        while stands[at] is None and at not in on:
            path.append(at)
            on.add(at)
            _, kind, start, end = found[at]
            ref = _REFERENCE.fullmatch(text, start, end) if kind == "bare" else None
            places = defined.get(ref[1], []) if ref else []
            before = bisect_left(places, at)
            after = before + (before < len(places) and places[before] == at)
            if before:
                at = places[before - 1]
            elif after < len(places):
                at = places[after]
        end = at if stands[at] is None else stands[at]
        for place in path:
            stands[place] = end
    return stands


def literal_spans(text: str) -> list[Span]:
    """Literals whose own shape and whose names, direct or by way of other names, look like a secret."""
    if "=" not in text and ":" not in text:
        return []
    names: dict[tuple[int, int], float] = {}
    found = pairs(text)
    for (name, *_), i in zip(found, resolved(text, found), strict=True):
        _, _, *span = found[i]
        names[tuple(span)] = max(name_score(name), names.get(tuple(span), 0.0))
    named = {span: score for span, score in names.items() if score}
    own = literal_scores(text, list(named))
    return sorted((s, "literal", e) for (s, e), score in named.items() if own[s, e] and score + own[s, e] >= THRESHOLD)


def spans_of(text: str) -> tuple[list[Span], list[tuple[int, int]]]:
    """All spans in order, and the (start, end) of the secrets themselves."""
    base = base_spans(text)
    more = [s for s in literal_spans(text) if not any(b[0] <= s[0] and s[2] <= b[2] for b in base)]
    spans = sorted([b[:3] for b in base] + more, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))
    return spans, sorted([(b[3], b[2]) for b in base] + [(s[0], s[2]) for s in more])


def _written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, their digest, and all spans."""
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for text in batch.column(1).to_pylist():
                spans, _ = spans_of(text or "")
                base = [s for s in spans if s[1] != "literal"]
                n = Counter(s[1] for s in base)
                digest = hashlib.sha256(_written(base).encode()).hexdigest()
                rows.append((n["assign"], n["access"], n["hex"], digest, _written(spans)))
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
            )

        return step

    return arrow_pass(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), schema, make)


def redacted(text: str, mark: str = "<redacted>") -> str:
    """The text with every secret replaced; overlapping secrets become one mark."""
    _, secrets = spans_of(text)
    out, done = [], 0
    for start, end in secrets:
        if start >= done:
            out += [text[done:start], mark]
        done = max(done, end)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame) -> DataFrame:
    """The documents with their secrets replaced; n_chars, if there is one, counts the new text."""
    schema = docs.schema

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            old = batch.column("text").to_pylist()
            new = [t if t is None else redacted(t) for t in old]
            changed = {"text": new}
            if "n_chars" in schema.names:
                before = batch.column("n_chars").to_pylist()
                changed["n_chars"] = [len(t) if t != o else n for t, o, n in zip(new, old, before, strict=True)]
            columns = [pa.array(changed[f.name], f.type) if f.name in changed else c for f, c in zip(batch.schema, batch.columns, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

        return step

    return arrow_pass(docs, schema, make)
