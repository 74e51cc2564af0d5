"""Wildcard terms: an index of their literal parts, and a check in linear time.

A term stands in a text as ``text LIKE '% term %'``. Cut at ``%``, that is a list of segments, each
with single open characters at most. They must follow each other in the text, and taking each at the
first place behind the one before it is as good as any other way, so that a text is read once, where
a backtracking comparison tries all combinations of places.

Which texts a term is compared with is found by a key of literal characters: a whole word, the
beginning or the end of one where a space stands beside it, else three characters in a row anywhere,
of a long list those that the fewest texts hold.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

from eventpulse._session import rows_if_small
from eventpulse._skew import salted, SALT
from eventpulse.functions.text import sql_list, sql_string

# A part of a pattern is looked up by at most so many characters.
PART_CHARS = 8
# Characters in a row that stand for a part inside of words.
GRAM = 3
# Texts are cut into grams by chunks of so many characters, as arrays of all grams would be large.
CHUNK_CHARS = 1 << 16
# Keys that are written into the plan, so that others are never made of a text.
PLAN_GRAMS = 10_000
# From so many terms with a choice of grams on, the texts are counted to choose the rarest.
COUNT_FROM = 256


def linear_regex(body: str) -> str:
    """A regular expression for texts with the LIKE pattern ``body`` between two spaces.

    Each segment is looked for from where the one before it ended, without a way back.
    """
    parts = re.findall(r"\\[%_\\]|[%_]|[^%_\\]+", f" {body} ")
    segments = [""]
    for p in parts:
        if p == "%":
            segments.append("")
        else:
            segments[-1] += "." if p == "_" else re.escape(p[1:] if p[0] == "\\" else p)
    return "".join(f"(?>.*?{s})" for s in segments if s)


# ---- the terms' side ----------------------------------------------------------

_ESCAPED = sql_string(r"\\[%_\\]")


def _segments(body: str) -> str:
    """SQL text: the segments of a pattern ``body`` between two spaces, as structs of a literal or,
    where characters are open, of a regular expression up to the segment's end."""
    whole = sql_string(r"((?:\\[%_\\]|[^%\\])+)")
    tokens = sql_string(r"(?s)(\\[%_\\]|.)")
    is_open = f"contains(regexp_replace(s, {_ESCAPED}, ''), '_')"
    plain = f"regexp_replace(s, {sql_string(r'\\([%_\\])')}, '$1')"
    quoted = (
        f"array_join(transform(regexp_extract_all(s, {tokens}, 1), t -> CASE WHEN t = '_' THEN '.' "
        f"ELSE concat({sql_string(r'\Q')}, right(t, 1), {sql_string(r'\E')}) END), '')"
    )
    return (
        f"transform(regexp_extract_all(concat(' ', {body}, ' '), {whole}, 1), s -> struct("
        f"CASE WHEN NOT {is_open} THEN {plain} END AS literal, "
        f"CASE WHEN {is_open} THEN concat({sql_string(r'(?s)\A(.*?')}, {quoted}, ')') END AS open))"
    )


def in_order(text: str, segments: str) -> str:
    """SQL text: whether the segments follow each other in the text."""
    found = f"locate(s.literal, {text}, p)"
    opened = f"length(regexp_extract(substring({text}, p), s.open, 1))"
    return (
        f"aggregate({segments}, 1, (p, s) -> CASE WHEN p = 0 THEN 0 "
        f"WHEN s.literal IS NOT NULL THEN CASE WHEN {found} = 0 THEN 0 ELSE {found} + length(s.literal) END "
        f"ELSE CASE WHEN {opened} = 0 THEN 0 ELSE p + {opened} END END) > 0"
    )


def _keys(parts: str) -> str:
    """SQL text: the keys of literal parts, ``=word``, ``<beginning``, ``>end`` or ``~gram``, each
    with how much it tells.

    The parts of a word are those between spaces; outer ones of a part without a space at that
    side are incomplete.
    """
    pieces = (
        f"filter(flatten(transform({parts}, p -> transform(split(p, ' ', -1), (w, i) -> struct(w, "
        f"i > 0 AS begins, i < size(split(p, ' ', -1)) - 1 AS ends)))), x -> length(x.w) > 0)"
    )
    n = f"least(length(x.w), {PART_CHARS})"
    beside = (
        f"CASE WHEN x.begins AND x.ends AND length(x.w) <= {PART_CHARS} "
        f"THEN array(struct({n} + 3 AS tells, concat('=', x.w) AS key)) "
        f"WHEN x.begins THEN array(struct({n} + 1 AS tells, concat('<', left(x.w, {PART_CHARS})) AS key)) "
        f"WHEN x.ends THEN array(struct({n} + 1 AS tells, concat('>', right(x.w, {PART_CHARS})) AS key)) "
        f"ELSE CAST(array() AS array<struct<tells: int, key: string>>) END"
    )
    inside = (
        f"transform(sequence(1, greatest(length(x.w) - {GRAM - 1}, 1)), i -> struct("
        f"least(length(x.w), {GRAM}) AS tells, concat('~', substring(x.w, i, {GRAM})) AS key))"
    )
    return f"flatten(transform({pieces}, x -> concat({beside}, {inside})))"


def indexed(names: DataFrame, literal: bool) -> DataFrame:
    """``_term, _segs, _best`` per term: its segments, and its keys that tell most; none where it has
    no literal character but spaces."""
    if literal:
        segments = "array(struct(concat(' ', _term, ' ') AS literal, CAST(NULL AS string) AS open))"
        parts = "array(concat(' ', _term, ' '))"
    else:
        # A backslash that escapes nothing is literal.
        body = (
            f"regexp_replace(_term, {sql_string(r'\G((?:[^\\]|\\[%_\\])*+)\\(?![%_\\])')}, "
            f"{sql_string(r'$1\\\\')})"
        )
        segments = _segments("_body")
        # Parts end at a wildcard, and at an escaped character to be on the safe side.
        parts = f"split(concat(' ', _term, ' '), {sql_string(r'[%_\\]')}, -1)"
        names = names.withColumn("_body", F.expr(body))
    keyed = names.select("_term", F.expr(segments).alias("_segs"), F.expr(parts).alias("_parts"))
    keyed = keyed.select("_term", "_segs", F.expr(_keys("_parts")).alias("_keys"))
    most = "array_max(transform(_keys, k -> k.tells))"
    return keyed.select(
        "_term", "_segs",
        F.expr(
            f"array_distinct(transform(filter(_keys, k -> k.tells = {most}), k -> k.key))"
        ).alias("_best"),
    )


# ---- the texts' side ------------------------------------------------------------

def _grams(q: int, listed: list[str] | None) -> str:
    """SQL text: the distinct runs of ``q`` characters of ``_text``, marked as keys."""
    pattern = "(?s)(.)" if q == 1 else f"(?s)(?=(.{{{q}}}))"
    chunk = f"substring(_text, CAST(c * {CHUNK_CHARS} + 1 AS INT), {CHUNK_CHARS + q - 1})"
    found = f"array_distinct(regexp_extract_all({chunk}, {sql_string(pattern)}, 1))"
    if listed is not None:
        found = f"filter({found}, g -> g IN {sql_list(listed)})"
    chunks = f"sequence(0, greatest(length(_text) - 1, 0) DIV {CHUNK_CHARS})"
    return f"array_distinct(flatten(transform({chunks}, c -> transform({found}, g -> concat('~', g)))))"


def _kinds(keyed: DataFrame) -> list[tuple[str, int]]:
    """Which marks and lengths of keys there are: a few marks, and at most ``PART_CHARS`` lengths."""
    kinds = keyed.select(F.left("_key", F.lit(1)).alias("kind"), (F.length("_key") - 1).alias("n"))
    return sorted((r.kind, r.n) for r in kinds.distinct().collect())


def _gram_arrays(keyed: DataFrame, lengths: list[int]) -> list[str]:
    grams = keyed.where("left(_key, 1) = '~'").select(F.substring("_key", 2, GRAM).alias("g")).distinct()
    rows = rows_if_small(grams, PLAN_GRAMS) if lengths else []
    listed = None if rows is None else [r.g for r in rows]
    return [
        _grams(q, None if listed is None else sorted(g for g in listed if len(g) == q)) for q in lengths
    ]


def _text_keys(keyed: DataFrame, words: str) -> str:
    """SQL text: all keys of a text, of the kinds that some term has."""
    kinds = _kinds(keyed)
    cuts = {
        "<": "transform(filter(ws, w -> length(w) >= {n}), w -> concat('<', left(w, {n})))",
        ">": "transform(filter(ws, w -> length(w) >= {n}), w -> concat('>', right(w, {n})))",
    }
    of_words = [cuts[kind].format(n=n) for kind, n in kinds if kind in cuts]
    if any(kind == "=" for kind, _ in kinds):
        of_words.append("transform(ws, w -> concat('=', w))")
    if any(kind == "" for kind, _ in kinds):
        of_words.append("array('')")
    arrays = _gram_arrays(keyed, [n for kind, n in kinds if kind == "~"])
    if of_words:
        arrays.append(
            f"flatten(transform(array({words}), ws -> array_distinct(concat({', '.join(of_words)}))))"
        )
    return f"concat({', '.join(arrays)})" if arrays else "CAST(array() AS array<string>)"


def _rarest(terms: DataFrame, texts: DataFrame) -> DataFrame:
    """``_term, _segs, _key``: one key a term, the one that the fewest texts hold where a long list
    leaves a choice between grams."""
    choice = terms.where("size(_best) > 1 AND left(_best[0], 1) = '~'")
    if choice.limit(COUNT_FROM).count() < COUNT_FROM:
        return terms.select("_term", "_segs", F.coalesce(F.get("_best", F.lit(0)), F.lit("")).alias("_key"))
    options = choice.select("_term", F.explode("_best").alias("_key")).where("left(_key, 1) = '~'")
    lengths = [n for _, n in _kinds(options)]
    arrays = _gram_arrays(options, lengths)
    counts = texts.select(F.explode(F.expr(f"concat({', '.join(arrays)})")).alias("_key")).groupBy(
        "_key"
    ).agg(F.count("*").alias("_n"))
    rated = options.join(counts, "_key", "left").groupBy("_term").agg(
        F.min_by("_key", F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_key")).alias("_rare")
    )
    return terms.join(rated, "_term", "left").select(
        "_term", "_segs",
        F.coalesce("_rare", F.get("_best", F.lit(0)), F.lit("")).alias("_key"),
    )


def meet_patterns(
    texts: DataFrame, names: DataFrame, literal: bool, words: str, small: bool, salts: int
) -> DataFrame:
    """``_digest, _term`` of the texts ``_digest, _text`` with the wildcard terms ``_term`` they hold.

    ``words`` is SQL text for the words of ``_text`` with their ends marked. A small list is
    broadcast; else the keys are shuffled, salted, as some are in most texts. A term without a
    literal character, such as ``%``, is compared with every text.
    """
    terms = _rarest(indexed(names, literal), texts)
    keys = F.explode(F.expr(_text_keys(terms, words))).alias("_key")
    if small:
        met = texts.select("_digest", "_text", keys).join(F.broadcast(terms), "_key")
    else:
        left, right = salted(texts.select("_digest", keys), terms, salts)
        # The texts join later: they would be repeated for every key.
        met = left.join(right, ["_key", SALT]).select("_digest", "_term", "_segs").join(texts, "_digest")
    return met.where(F.expr(in_order("_text", "_segs"))).select("_digest", "_term")
