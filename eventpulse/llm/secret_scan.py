"""Secrets in texts: fixed patterns, and assignment-aware lexing.

The lexer reads source and configuration syntax line by line into pairs of a target name and a
value: ``name = "x"``, ``name: x``, ``"name" => 'x'``, ``name := x``, ``export NAME=x``,
``<name>x</name>`` with or without attributes. A literal may have a prefix, as ``b"x"``, or triple
quotes. A value is a literal, another name, or a sum of these. Names that stand for
constants are propagated through the text, forwards, until the literal is known, so that
``a = "..."`` followed by ``db_password = a`` scores the literal of ``a`` by the name
``db_password``. A literal is scored by how sensitive the names are that it reaches, and by how
much it looks like a key rather than a word or a placeholder.

Each text is scanned on its own in one pass, in Arrow batches: no shuffle, and memory for one
batch. Patterns run only over texts that hold what they begin with.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from eventpulse.llm._common import col, free_name

# The base patterns of the contract, and the least length of what they find.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ASSIGN_VALUE = 6
# A run that is too short has no longer run inside, so the length can stand in the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
BEGINS = ("passw", "secret", "token", "api")
KINDS = ("assign", "access", "hex", "literal")

# How sensitive a part of a name is, and parts that speak against a secret.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.8,
    "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "privatekey": 1.0, "accesskey": 1.0,
    "secretkey": 1.0, "authkey": 0.9, "bearer": 0.8, "connectionstring": 0.7, "salt": 0.5,
    "auth": 0.5, "key": 0.4, "pin": 0.4,
}
# Before "key", these make as sensitive a name as "privatekey".
SENSITIVE |= {
    f"{kind}key": 1.0 for kind in (
        "encryption", "encrypt", "encrypted", "decryption", "signing", "signature", "sign", "ssh", "hmac",
        "master", "rsa", "aes", "dsa", "ssl", "tls", "pgp", "gpg", "jwt", "crypto", "cipher", "session",
        "shared", "host", "license",
    )
}
# Names of this weight at least may hold a phrase of several words.
STRONG = 0.9
# Names from this weight on count in full before a literal that looks random.
WEAK = 0.35
# Parts that make a key public wherever they stand, and parts that do at the end of a name.
NO_SECRET = frozenset(("public", "foreign", "primary", "sort"))
HARMLESS = frozenset((
    "public", "name", "file", "path", "url", "count", "length", "type", "id", "expires", "limit",
    "size", "max", "min", "foreign", "primary", "sort",
))
PLACEHOLDER = re.compile(
    r"(?i)^(?:change.?me|example|sample|dummy|test|todo|none|null|true|false|xxx+|\*+|\.+|<.*>"
    r"|\$\{.*\}|\{\{.*\}\}|%.*%|your[_-].*|placeholder|password|secret|token)$"
)
THRESHOLD = 0.6

_NAME = r"[A-Za-z_][A-Za-z0-9_]*(?:[.\-][A-Za-z_][A-Za-z0-9_]*)*"
_WHOLE_NAME = re.compile(_NAME).fullmatch
# A name begins where no name goes on, so that a long run of letters is tried once.
_TARGET = re.compile(
    rf"""(?<![A-Za-z0-9_])(?<![A-Za-z0-9_][.\-])(?:(?P<q>["'])(?P<quoted>{_NAME})(?P=q)|(?P<bare>{_NAME}))(?:\[(?:[^\[\]\n]|\[[^\[\]\n]*+\])*+\])?"""
    r"""[ \t]*(?::[ \t]*[A-Za-z_][\w.\[\]]*+[ \t]*(?==))?(?:=>|:=|\+=|==|=|:(?!//))[ \t]*"""
)
_XML = re.compile(rf"<(?P<tag>{_NAME})(?:\s[^<>]*+)?>(?P<value>[^<>\n]++)</(?P=tag)>")
# A prefix, and triple quotes over lines before others. What is possessive needs no bound.
_QUOTED = re.compile(
    r"[bBrRuUfFlLtT@$]{0,2}(?:"
    r'"""((?:[^"\\]|\\[\s\S]|"(?!""))*+)"""' + r"|'''((?:[^'\\]|\\[\s\S]|'(?!''))*+)'''"
    r'|"((?:[^"\\\n]|\\.)*+)"' + r"|'((?:[^'\\\n]|\\.)*+)')"
)
_PLUS = re.compile(r"[ \t]*(?:\+|\.\.)[ \t]*")
_BARE = re.compile(r"""[^\s,;"'()\[\]{}<>]+""")
# Every sensitive name holds one of these.
_HINT = re.compile("pass|pwd|secret|token|key|credential|bearer|connectionstring|salt|auth|pin", re.I)
_UNSEPARATED = str.maketrans("", "", "_.-")
# What a value may begin with.
_BEARS = re.compile(r"""[^\s,;()\[\]{}<>]""")
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def name_weight(name: str) -> float:
    """How sensitive a target name is, from 0 to 1, by its parts and by neighbouring parts joined.

    Different parts add up.
    """
    # Each of these names, whole or joined, stands in the name without its separators.
    if not _HINT.search(name.translate(_UNSEPARATED)):
        return 0.0
    parts = [p.lower() for p in _PARTS.findall(name)]
    joined = [a + b for a, b in zip(parts, parts[1:])]
    weight = max((SENSITIVE.get(p, 0.0) for p in joined), default=0.0)
    weight = max(weight, min(1.0, sum(SENSITIVE.get(p, 0.0) for p in dict.fromkeys(parts))))
    if weight < 0.6 and not NO_SECRET.isdisjoint(parts):
        weight *= 0.3
    return weight * (0.3 if parts and parts[-1] in HARMLESS else 1.0)


def randomness(value: str) -> float:
    """From 0 to 1, how often a literal changes from letters to digits or back, or to upper case.

    Random ones do so at every third character or so, words and names of a program hardly.
    """
    if len(value) < 10 or any(c.isspace() for c in value):
        return 0.0
    changes = sum(
        a.isdigit() != b.isdigit() and a.isalnum() and b.isalnum() or a.islower() and b.isupper()
        for a, b in zip(value, value[1:])
    )
    return min(1.0, max(0.0, changes / (len(value) - 1) - 0.18) / 0.15)


def literal_weight(value: str, phrase: bool = False) -> float:
    """How much a literal looks like a secret: length, entropy, kinds of characters.

    White space is allowed in a ``phrase`` only.
    """
    if len(value) < 6 or PLACEHOLDER.match(value) or not phrase and any(c.isspace() for c in value):
        return 0.0
    n = len(value)
    entropy = -sum(k / n * math.log2(k / n) for k in Counter(value).values())
    kinds = sum(any(f(c) for c in value) for f in (str.islower, str.isupper, str.isdigit))
    mixed = kinds + any(not c.isalnum() for c in value)
    return min(1.0, 0.3 + 0.1 * entropy + 0.1 * mixed)


def _value_bounds(text: str, targets: list[re.Match]) -> list[int]:
    """Where the unquoted value of each target ends at the latest.

    A run without blanks may hold many targets, as the query string of a url does. Its pieces end
    before an ``&`` and a target. The first target of a piece has the whole piece for its value, the
    last what is left of it, and those between what stands before the next target, so that all
    values together are at most twice as long as the text.
    """
    bounds, run_end, owned = [], 0, 0
    # The first target behind each that begins a piece.
    opens, following = [len(text) + 1] * len(targets), len(text) + 1
    for i in range(len(targets) - 1, -1, -1):
        opens[i] = following
        start = targets[i].start()
        if start and text[start - 1] == "&":
            following = start
    for i, m in enumerate(targets):
        at = m.end()
        if at >= run_end:
            run = _BARE.match(text, at)
            run_end = run.end() if run else at
        end = min(run_end, opens[i] - 1)
        if at < owned:  # within the piece of another target
            if i + 1 < len(targets):
                end = min(end, targets[i + 1].start())
        else:
            owned = end
        bounds.append(max(end, at))
    return bounds


def assignments(text: str) -> Iterator[tuple[str, list[tuple[str, str, int, int]]]]:
    """Pairs of target name and terms of its value, in the order of the text.

    A term is ``("literal", value, start, end)`` or ``("name", name, start, end)``. Terms joined by a
    plus are read up to the next target, so that the time is in proportion to the text.
    """
    found = []
    bears = _BEARS.match
    targets = [
        m for m in _TARGET.finditer(text)
        if bears(text, m.end()) and not text[m.start():m.end()].rstrip().endswith("==")
    ]
    for i, (m, bound) in enumerate(zip(targets, _value_bounds(text, targets))):
        following = targets[i + 1].start() if i + 1 < len(targets) else len(text)
        terms, at = [], m.end()
        while True:
            if quoted := _QUOTED.match(text, at):
                k = quoted.lastindex
                value, start = quoted.group(k), quoted.start(k)
                if k < 3:  # without the lines' ends inside triple quotes
                    start += len(value) - len(value.lstrip())
                    value = value.strip()
                terms.append(("literal", value, start, start + len(value)))
                at = quoted.end()
            elif bare := _BARE.match(text, at, bound if at == m.end() else max(at, following)):
                word = bare.group(0)
                kind = "name" if _WHOLE_NAME(word) else "literal"
                terms.append((kind, word, bare.start(), bare.end()))
                at = bare.end()
            else:
                break
            plus = _PLUS.match(text, at) if at < following else None
            if not plus or plus.end() >= following:
                break
            at = plus.end()
        if terms:
            found.append((m.start(), m.group("quoted") or m.group("bare"), terms))
    if "</" in text:
        for m in _XML.finditer(text):
            value = ("literal", m.group("value"), m.start("value"), m.end("value"))
            found.append((m.start(), m.group("tag"), [value]))
    for _, name, terms in sorted(found, key=lambda f: f[0]):
        yield name, terms


def literal_spans(text: str, threshold: float = THRESHOLD) -> list[tuple[int, int, float]]:
    """Spans of literals that reach a sensitive name, with their score."""
    # A node per assignment: its own literals, and the nodes of the constants that it uses.
    own: list[list[tuple[int, int]]] = []
    uses: list[list[int]] = []
    latest: dict[str, int] = {}
    sensitive_nodes = []
    for name, terms in assignments(text):
        weight, node = name_weight(name), len(own)
        own.append([])
        uses.append([])
        for kind, value, start, end in terms:
            if kind == "name" and value in latest:
                uses[node].append(latest[value])
            elif kind == "literal" or weight and any(c.isdigit() for c in value):
                own[node].append((start, end))  # also a bare word of a configuration file
        latest[name] = node
        if weight:
            sensitive_nodes.append((-weight, node))
    # From the most sensitive name down, so that each node needs one visit.
    weights: dict[tuple[int, int], float] = {}
    seen: set[int] = set()
    for weight, first in sorted(sensitive_nodes):
        todo = [first]
        while todo:
            node = todo.pop()
            if node not in seen:
                seen.add(node)
                todo += uses[node]
                for span in own[node]:
                    weights.setdefault(span, -weight)
    spans = []
    for (start, end), sensitive in weights.items():
        value = text[start:end]
        if sensitive >= WEAK:  # a random literal makes up for a weaker name
            named = sensitive + (1 - sensitive) * randomness(value)
        else:
            named = sensitive
        score = named * literal_weight(value, sensitive >= STRONG)
        if score >= threshold:
            spans.append((start, end, score))
    return sorted(spans)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the three base patterns, ordered by start, then kind."""
    spans = []
    folded = text.lower()
    if any(b in folded for b in BEGINS):
        spans += [
            ("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_VALUE
        ]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text)]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(spans, key=_by_start)


def _by_start(span: tuple) -> tuple:
    return span[1], KINDS.index(span[0]), span[2]


def all_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans and those of the lexer, ordered by start, then kind."""
    spans = base_spans(text)
    if "=" in text or ":" in text or "</" in text:
        spans += [("literal", start, end) for start, end, _ in literal_spans(text)]
    return sorted(spans, key=_by_start)


def redact(text: str, mark: str = "[SECRET]") -> str:
    """The text with the union of its spans replaced; a text without spans is the same object."""
    spans = all_spans(text)
    if not spans:
        return text
    out, done = [], 0
    for _, start, end in spans:
        if start >= done:
            out += [text[done:start], mark]
        done = max(done, end)
    return "".join([*out, text[done:]])


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find_secrets(
    table: DataFrame, *, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``table``: ``doc_id`` and ``spans``, an array of kind, start and end.

    Positions count code points, the end is exclusive. A null text counts as empty and has no
    spans. Ids may be null or repeated; other columns are not looked at.
    """
    rows = table.select(col(id_column).alias("doc_id"), col(text).cast("string").alias("text"))

    def scan(batches):
        for batch in batches:
            spans = [
                [dict(kind=k, start=s, end=e) for k, s, e in all_spans(t)] if t else []
                for t in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, SPANS)], ["doc_id", "spans"]
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, spans array<struct<kind: string, start: bigint, end: bigint>>"
    return rows.mapInArrow(scan, schema)


def redact_secrets(table: DataFrame, *, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The same rows and columns with every secret in ``text`` replaced by ``mark``.

    A null text stays null; a text without a secret is unchanged.
    """

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t if t is None else redact(t, mark))

    name = free_name(table, "_cleaned")
    out = table.withColumn(name, cleaned(col(text)))
    return out.select(*[
        col(name).alias(c) if c == text else col(c) for c in table.columns
    ])


def by_kind(kind: str, spans: str = "spans") -> Column:
    """How many spans of a kind a row has."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
