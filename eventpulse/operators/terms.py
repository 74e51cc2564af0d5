"""Flagging posts that contain a term of a filter list.

A term matches where it stands between two spaces: ``text LIKE '% term %'``. It
is case-sensitive, does not match at either end of the text or next to
punctuation, and ``%``/``_`` in a term are wildcards unless ``mode="literal"``.

Run as a theta join this compares every post with every term. Here the list is
compiled into one predicate over the words of a post, so the flagging is part of
the scan: no join, no shuffle, and for exact terms a cost that does not grow with
the list. A list too large for that, or with many wildcards, is joined to the words.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F

from eventpulse._session import rows_if_small, shared_folder
from eventpulse._skew import SALT, digest, salted
from eventpulse.functions.text import sql_list, sql_string
from eventpulse.operators.patterns import linear_regex, meet_patterns

PER_POST = "per_post"
PER_TERM = "per_term"
LIKE = "like"
LITERAL = "literal"

# A list of at most this many terms, none of them very long, is written into the plan.
MAX_PLAN_TERMS = 10_000
# Wildcard terms are tried one after the other on the whole text.
MAX_PLAN_PATTERNS = 20

# A longer list is broadcast up to this many terms, in blocks of so many terms or characters. Wildcard
# terms that are looked up by a part of them are broadcast up to fewer, as their segments go along.
BROADCAST_TERMS = 8_000_000
BLOCK_TERMS = 2_000_000
BLOCK_CHARS = 64_000_000
BROADCAST_PATTERNS = 100_000

# Up to so many words a per-row overlap of two arrays beats a lookup per word,
# and up to so many phrases a scan per phrase beats building all word runs.
FEW_WORDS = 64
FEW_PHRASES = 8

# Put at both ends of a text before it is split, it keeps the outer words from
# equalling any term.
EDGE = "\0"


@dataclass(frozen=True)
class TermSet:
    """A compiled filter list: exact phrases by number of words, and wildcard terms.

    ``patterns`` holds each wildcard term with its LIKE pattern between the
    spaces; ``repeated`` says that the list named a term more than once.
    """

    phrases: dict[int, tuple[str, ...]]
    patterns: tuple[tuple[str, str], ...]
    repeated: bool = False

    @staticmethod
    def of(terms: list[str | None], mode: str = LIKE) -> TermSet:
        """Sort terms into phrases and patterns; null terms never match."""
        if mode not in (LIKE, LITERAL):
            raise ValueError(f"mode must be {LIKE!r} or {LITERAL!r}, not {mode!r}")
        phrases: dict[int, list[str]] = defaultdict(list)
        patterns: list[tuple[str, str]] = []
        named = [t for t in terms if t is not None]
        for term in sorted(set(named)):
            if _needs_pattern(term, mode):
                patterns.append((term, _like_body(term, mode)))
            else:
                phrases[term.count(" ") + 1].append(term)
        return TermSet(
            {k: tuple(v) for k, v in sorted(phrases.items())},
            tuple(patterns),
            repeated=len(named) > len(set(named)),
        )

    def found_in(self, text: str) -> Column:
        """Whether any term occurs in the column ``text``."""
        column = F.col(f"`{text}`")
        tests: list[Column] = []
        if self.patterns:
            bodies = "|".join(linear_regex(body) for _, body in self.patterns)
            tests.append(column.rlike(rf"(?s)\A(?:{bodies})"))
        for k, phrases in self.phrases.items():
            if k == 1 and len(phrases) <= FEW_WORDS:
                few = F.array(*[F.lit(p) for p in phrases])
                tests.append(F.arrays_overlap(F.expr(_words(text)), few))
            elif k == 1:
                tests.append(F.expr(f"exists({_words(text)}, w -> w IN {sql_list(phrases)})"))
            elif len(phrases) <= FEW_PHRASES:
                tests += [column.contains(f" {p} ") for p in phrases]
            else:
                tests.append(F.expr(
                    f"exists(array({_words(text)}), "
                    f"ws -> exists({_starts('ws', k)}, i -> {_is_phrase(k, phrases)}))"
                ))
        return reduce(or_, tests) if tests else F.lit(False)

    def matches_in(self, text: str) -> Column:
        """The distinct terms that occur in the column ``text``, as an array."""
        exact = []
        for k, phrases in self.phrases.items():
            if k == 1:
                exact.append(f"filter(ws, w -> w IN {sql_list(phrases)})")
            else:
                starts = f"filter({_starts('ws', k)}, i -> {_is_phrase(k, phrases)})"
                exact.append(f"transform({starts}, i -> {_run(k)})")
        tried = [
            f"CASE WHEN `{text}` RLIKE {sql_string(rf'(?s)\A{linear_regex(body)}')} "
            f"THEN {sql_string(term)} END"
            for term, body in self.patterns
        ]
        parts = [f"array_compact(array({', '.join(tried)}))"] if tried else []
        if exact:
            found = f"concat({', '.join(exact)})"
            parts.append(f"flatten(transform(array({_words(text)}), ws -> {found}))")
        if not parts:
            return F.array().cast("array<string>")
        return F.expr(f"array_distinct(concat({', '.join(parts)}))")


def compile_terms(
    terms: DataFrame, *, column: str = "term", mode: str = LIKE, max_terms: int = MAX_PLAN_TERMS
) -> TermSet | None:
    """The filter list as a :class:`TermSet`, or None when it is beyond the bound."""
    rows = rows_if_small(terms.select(F.col(f"`{column}`").alias("term")), max_terms)
    found = None if rows is None else TermSet.of([r.term for r in rows], mode)
    return found if found is None or len(found.patterns) <= MAX_PLAN_PATTERNS else None


def flag_posts(
    posts: DataFrame,
    terms: DataFrame,
    *,
    text: str = "text",
    term: str = "term",
    multiplicity: str = PER_POST,
    mode: str = LIKE,
    max_terms: int = MAX_PLAN_TERMS,
    broadcast_terms: int = BROADCAST_TERMS,
) -> DataFrame:
    """Posts with a term of the list.

    ``per_post`` keeps the rows of ``posts`` that match. ``per_term`` gives one
    row per matching pair, with the columns of both sides. Copies are kept in
    both; see :func:`drop_copies`.
    """
    if multiplicity not in (PER_POST, PER_TERM):
        raise ValueError(f"multiplicity must be {PER_POST!r} or {PER_TERM!r}")
    compiled = compile_terms(terms, column=term, mode=mode, max_terms=max_terms)
    if compiled is None:
        return _flag_by_join(posts, terms, text, term, multiplicity, mode, broadcast_terms)
    flagged = posts.where(compiled.found_in(text))
    if multiplicity == PER_POST:
        return flagged
    matched = flagged.withColumn("_term", F.explode(compiled.matches_in(text)))
    if terms.columns == [term] and not compiled.repeated:
        return matched.select(*posts.columns, F.col("_term").alias(term))
    return _both_sides(matched, terms, posts, terms, ("_term", term))


def drop_copies(flagged: DataFrame, text: str = "text", time: str = "timestamp_ms") -> DataFrame:
    """Distinct ``(text, time)``: of exact copies of a post, one is kept.

    The grouping combines copies before the shuffle, so a text that makes up a
    third of the input costs one row per task.
    """
    return flagged.select(text, time).distinct()


def matched_timestamps(flagged: DataFrame, time: str = "timestamp_ms") -> DataFrame:
    """The time of every flagged post as it was read, parsable or not."""
    return flagged.select(F.col(time).cast("string").alias("Timestamp"))


def _needs_pattern(term: str, mode: str) -> bool:
    return EDGE in term or (mode == LIKE and re.search(r"[%_\\]", term) is not None)


def _like_body(term: str, mode: str) -> str:
    """The term inside a LIKE pattern; a backslash that escapes nothing is literal."""
    if mode == LITERAL:
        return re.sub(r"([%_\\])", r"\\\1", term)
    return re.sub(r"\\([%_\\])|\\", lambda m: m.group(0) if m.group(1) else r"\\", term)


# In the SQL text below, a one-element array binds the words of a text to the
# lambda variable `ws`; written out, they would be split anew for every element.

def _words(text: str) -> str:
    return f"split(concat('\\0', `{text}`, '\\0'), ' ', -1)"


def _starts(words: str, k: int) -> str:
    """Positions (from 1) at which a run of k words starts."""
    return (
        f"CASE WHEN size({words}) >= {k} THEN sequence(1, size({words}) - {k - 1}) "
        f"ELSE cast(array() AS array<int>) END"
    )


def _run(k: int) -> str:
    """The k words of ``ws`` from position ``i`` on."""
    return "element_at(ws, i)" if k == 1 else f"array_join(slice(ws, i, {k}), ' ')"


def _is_phrase(k: int, phrases: tuple[str, ...]) -> str:
    """Whether a phrase starts at ``i``; the run is built only where its first word fits."""
    heads = sorted({p.split(" ", 1)[0] for p in phrases})
    return f"element_at(ws, i) IN {sql_list(heads)} AND {_run(k)} IN {sql_list(phrases)}"


def _both_sides(
    matched: DataFrame, side: DataFrame, posts: DataFrame, terms: DataFrame, *keys: tuple[str, str]
) -> DataFrame:
    """All columns of the post, then all of the filter list, joined on pairs of columns."""
    on = reduce(and_, [F.col(f"p.`{p}`") == F.col(f"t.`{t}`") for p, t in keys])
    return matched.alias("p").join(side.alias("t"), on).select(
        *[F.col(f"p.`{c}`") for c in posts.columns], *[F.col(f"t.`{c}`") for c in terms.columns]
    )


def _flag_by_join(
    posts: DataFrame, terms: DataFrame, text: str, term: str, multiplicity: str, mode: str,
    broadcast_terms: int = BROADCAST_TERMS, salts: int = 16,
) -> DataFrame:
    """The same result for a list of any size.

    A term that is one word, exact or with one open character, is looked for by the words of a text.
    With a list that can be broadcast and has no other columns, this is done where the posts are, and
    nothing but what was found goes on.

    Otherwise a match depends on the text alone: which terms a text holds is found by digests of the
    texts, and joined back to the posts. An exact term is looked for by its first word, and the run that
    begins there compared with it; a wildcard term by literal characters of it, and the text compared
    with the whole term (:mod:`eventpulse.operators.patterns`). A list within the bound is broadcast to the words, so that
    only what was found is shuffled. Beyond it the words of the distinct texts are, and the join is
    salted, as some words are in most texts. The matches are too many to repeat: where one text is
    a third of all posts, adaptive execution splits that part of the last join.
    """
    name = F.col(f"`{term}`")
    names = terms.select(name.alias("_term")).where("_term is not null").groupBy("_term").agg(
        F.count("*").alias("_copies")
    )
    wild = F.contains(F.col("_term"), F.lit(EDGE))
    if mode == LIKE:
        wild = wild | F.col("_term").rlike(r"[%_\\]")
    masked = wild & F.col("_term").rlike(ONE_OPEN) if mode == LIKE else F.lit(False)
    length = F.size(F.split("_term", " ", -1))
    # The list may be the result of a job; it is looked at several times.
    listed = shared_folder(names.sparkSession, "terms")
    names.write.parquet(listed)
    names = names.sparkSession.read.schema(names.schema).parquet(listed)
    # All that has to be known about it, in one pass.
    known = names.agg(
        F.count("*").alias("terms"), F.count_if(~wild & (length == 1)).alias("one"),
        F.count_if(~wild & (length > 1)).alias("more"),
        F.collect_set(F.when(masked, F.instr("_term", "_"))).alias("places"),
        F.count_if(wild & ~masked).alias("rest"), F.coalesce(F.sum(F.length("_term")), F.lit(0)).alias("chars"),
        F.max("_copies").alias("copies"),
    ).first()
    blocks = max(-(-known.terms // BLOCK_TERMS), -(-known.chars // BLOCK_CHARS), 1)
    if known.terms > broadcast_terms or blocks > BROADCAST_TERMS // BLOCK_TERMS:
        blocks = 0
    names = names.select("_term")
    one = names.where(~wild & (length == 1)).withColumn("_key", F.col("_term"))
    open_ = names.where(masked).withColumn("_key", F.col("_term"))
    words = "array_distinct({})".format
    looked_up = [(one, words("_ws"))] if known.one else []
    if known.places:
        looked_up.append((open_, _masked_words(sorted(known.places))))

    near = None
    if multiplicity == PER_TERM and blocks and terms.columns == [term] and (known.copies or 0) <= 1:
        split = posts.withColumn("_ws", F.expr(_words(text)))
        met = [
            _meet(split.select(*posts.columns, F.explode(F.expr(keys)).alias("_key")), side, blocks, salts)
            for side, keys in looked_up
        ]
        near = [
            m.select(*[F.col(f"`{c}`") for c in posts.columns], F.col("_term").alias(term)) for m in met
        ]
        looked_up = []
        if near and not known.more and not known.rest:
            return reduce(DataFrame.unionAll, near)

    texts = posts.select(F.col(f"`{text}`").alias("_text")).where("_text is not null")
    texts = (texts if blocks else texts.distinct()).withColumn("_digest", digest("_text"))
    cut = texts.select("_digest", F.expr(_words("_text")).alias("_ws"))

    found = names.select(F.unhex("_term").alias("_digest"), "_term").limit(0)
    for side, keys in looked_up:
        met = _meet(cut.select("_digest", F.explode(F.expr(keys)).alias("_key")), side, blocks, salts)
        found = found.unionByName(met.select("_digest", "_term"))
    if known.more:
        place = F.posexplode("_ws").alias("_at", "_key")
        more = names.where(~wild & (length > 1)).select(
            F.substring_index("_term", " ", 1).alias("_key"), "_term", length.alias("_k")
        )
        met = _meet(cut.select("_digest", "_ws", place), more, blocks, salts)
        met = met.where(F.expr("array_join(slice(_ws, _at + 1, _k), ' ') = _term"))
        found = found.unionByName(met.select("_digest", "_term"))
    if known.rest:
        small = blocks > 0 and known.rest <= BROADCAST_PATTERNS
        found = found.unionByName(meet_patterns(
            texts, names.where(wild & ~masked), mode == LITERAL, _words("_text"), small, salts
        ))

    if multiplicity == PER_POST:
        # Texts combine before the shuffle. On another form of the digest than they were grouped by, so
        # that the join has a shuffle of its own, which can be split.
        held = found.select("_digest").distinct().select(F.hex("_digest").alias("_hex"))
        keyed = posts.withColumn("_hex", F.hex(digest(text)))
        return keyed.join(held, "_hex", "left_semi").select(*posts.columns)
    keyed = posts.withColumn("_digest", digest(text))
    rows = _both_sides(found.distinct(), terms, found, terms, ("_term", term))
    rows = rows.select("_digest", *terms.columns)
    both = _both_sides(keyed, rows, posts, terms, ("_digest", "_digest"))
    return reduce(DataFrame.unionAll, near, both) if near else both


def _meet(words: DataFrame, terms: DataFrame, blocks: int, salts: int) -> DataFrame:
    """Join on ``_key``: the terms are broadcast in so many blocks, or shuffled if in none."""
    if not blocks:
        left, right = salted(words, terms, salts)
        return left.join(right, ["_key", SALT])
    if blocks == 1:
        return words.join(F.broadcast(terms), "_key")
    # A key is in one block only, and the words pass through the blocks once.
    block = F.pmod(F.xxhash64("_key"), F.lit(blocks))
    others = [c for c in terms.columns if c != "_key"]
    for b in range(blocks):
        side = terms.where(block == b).select("_key", F.struct(*others).alias(f"_block_{b}"))
        words = words.join(F.broadcast(side), "_key", "left")
    hit = F.coalesce(*[f"_block_{b}" for b in range(blocks)])
    kept = [c for c in words.columns if not c.startswith("_block_")]
    return words.where(hit.isNotNull()).select(*[F.col(f"`{c}`") for c in kept], hit.alias("_hit")).select(
        *[F.col(f"`{c}`") for c in kept], "_hit.*"
    )


# A term of one word whose only wildcard is one open character, among its first so many.
MASK_PLACES = 16
ONE_OPEN = rf"^[^ %_\\\x00]{{0,{MASK_PLACES - 1}}}_[^ %_\\\x00]*$"


def _masked_words(places: list[int]) -> str:
    """SQL text: the words of ``_ws`` but the outer two, with the character at one of these places
    masked. A term with one open character equals one of them, so that no comparison is left.

    The character may also be the space between two words.
    """
    keys = [
        f"transform(filter(ws, w -> length(w) >= {k}), "
        f"w -> concat(left(w, {k - 1}), '_', substring(w, {k + 1})))"
        for k in places
    ] + [
        f"transform(filter(sequence(0, size(ws) - 1), i -> i < size(ws) - 1 AND "
        f"length(ws[i]) = {k - 1}), i -> concat(ws[i], '_', ws[i + 1]))"
        for k in places
    ]
    return (
        "flatten(transform(array(slice(_ws, 2, greatest(size(_ws) - 2, 0))), "
        f"ws -> array_distinct(concat({', '.join(keys)}))))"
    )
