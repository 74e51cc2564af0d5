"""SentencePiece segmentations sampled without replacement, and decoding.

A text's lattice has a node between any two characters and an edge for every piece that fits.
Edges are weighted by the pieces' ranks, ``(rank + RANK_OFFSET) ** -sharpness``, and a segmentation
has a probability in proportion to its product of weights. The first ``k`` segmentations in order
of Gumbel-perturbed log probabilities are a sample of ``k`` without replacement. They are found by
a perturbed A* search: an agenda holds sets of segmentations with the perturbed maximum of each;
the set of the largest maximum is opened by fixing one segmentation in it, edge by edge, and at
every node of that path the edges not taken form a new set, whose maximum is drawn below that of
the path. Nothing is enumerated, and each sample costs one path. The inclusion score of a sample is
the logarithm of its probability of being among the ``k``, given the perturbed value of the best
segmentation that was left out.

Perturbed values are kept as the logarithms of arrival times, ``-gumbel``: below a maximum, the time
of a set of probability ``m`` is the path's time plus an exponential of rate ``m``.

No piece goes on beyond a blank, so a lattice is a chain of words' lattices. Those of the distinct
words of some texts are built together in arrays, and all paths of these texts grow together. The
uniform numbers come from a hash of the row's key, what they are for, the sample, the word or edge
and the step, so no number is used twice, and a row gets the same samples wherever and whenever it
is computed.
"""

from __future__ import annotations

import functools
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from eventpulse.llm._common import col

SAMPLES = 2
SHARPNESS = 0.25
RANK_OFFSET = 10
SEED = 11
BATCH_CHARS = 1_000_000
SPACE = "▁"  # fixed value: the character that stands for a blank in pieces

# Sets whose probability is e ** NEAR times less than that of a path's first own node come late.
NEAR = 48.0
# No logarithm of an exponential number is less, as uniform numbers are below 1 by 2 ** -53 at least.
LEAST_WAIT = float(np.log(2.0**-53)) - 0.5

_SLOT_BITS = 18
# First counters of random numbers, one for each use.
_FIRST, _GROWTH, _WAIT, _BRANCH, _AGAIN = range(5)
_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Pieces:
    """A model's pieces: hashes of all their beginnings, sorted, with the piece that ends there."""

    hashes: np.ndarray
    ids: np.ndarray
    weights: np.ndarray
    byte_weight: float
    byte_ids: np.ndarray
    texts: pa.LargeBinaryArray
    longest: int
    slots: np.ndarray

    def ends_at(self, keys: np.ndarray) -> np.ndarray:
        """Place of each hash among the sorted ones, -1 where it is not there.

        The leading bits name the first place to look at, and few hashes share them.
        """
        place = self.slots[keys >> np.uint64(64 - _SLOT_BITS)]
        there = self.hashes[place]
        out = np.where(there == keys, place, -1)
        look = np.flatnonzero(there < keys)
        keys, place = keys[look], place[look] + 1
        while len(look):
            there = self.hashes[place]
            same = there == keys
            out[look[same]] = place[same]
            on = there < keys
            look, keys, place = look[on], keys[on], place[on] + 1
        return out

    @staticmethod
    def of(model, sharpness: float = SHARPNESS) -> Pieces:
        size = model.get_piece_size()
        special = {
            i for i in range(size)
            if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
        }
        normal = sorted((i for i in range(size) if i not in special), key=lambda i: (-model.get_score(i), i))
        weights = np.zeros(size)
        weights[normal] = -sharpness * np.log(np.arange(len(normal)) + RANK_OFFSET)
        ends: dict[int, int] = {}
        for i in normal:
            h, piece = 0, model.id_to_piece(i)
            for c in piece:
                h = _extended(h, ord(c))
                ends.setdefault(_spread(h), -1)
            ends[_spread(h)] = i
        # The last one is no beginning of a piece, but an end to every look.
        hashes = np.array([*sorted(ends), (1 << 64) - 1], np.uint64)
        ends.setdefault((1 << 64) - 1, -1)
        slots = np.searchsorted(
            hashes, np.arange(1 << _SLOT_BITS, dtype=np.uint64) << np.uint64(64 - _SLOT_BITS)
        ).astype(np.int32)
        byte_ids = np.zeros(256, np.int64)
        for i in range(size):
            if model.is_byte(i):
                byte_ids[int(model.id_to_piece(i)[3:5], 16)] = i
        return Pieces(
            hashes, np.array([ends[h] for h in hashes.tolist()]), weights,
            -sharpness * float(np.log(len(normal) + RANK_OFFSET)), byte_ids, piece_texts(model),
            max(len(model.id_to_piece(i)) for i in normal), slots,
        )


def piece_texts(model) -> pa.LargeBinaryArray:
    """What each piece stands for, as bytes; control pieces for nothing."""
    texts = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            texts.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            texts.append(b"")
        else:
            texts.append(piece.replace(SPACE, " ").encode())
    return pa.array(texts, pa.large_binary())


def _extended(h: int, code: int) -> int:
    return (h * int(_STEP) + code + 1) & 0xFFFFFFFFFFFFFFFF


def _spread(h: int) -> int:
    """Moves differences of short pieces into the leading bits."""
    return h * int(_STEP) & 0xFFFFFFFFFFFFFFFF


class Lattice:
    """The lattices of some words; positions of all words are numbered through by what is left of the word.

    ``first[w]`` is a word's first position, and ``end_of_word`` stands behind the last character of any.
    Edges are sorted by where they begin; ``begin[p]`` is the first edge of position ``p``. An ``id`` of
    ``size + c`` stands for the bytes of a character ``c`` beyond ASCII.
    """

    def __init__(self, words: list[str], pieces: Pieces):
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        n_codes = self.end_of_word = len(codes)
        begins = np.cumsum(sizes) - sizes
        left = np.repeat(begins + sizes, sizes) - np.arange(n_codes)
        longest = int(sizes.max(initial=0))
        cuts = np.cumsum(np.bincount(left, minlength=longest + 1)).tolist()
        # Small numbers sort faster as such.
        order = np.argsort(left.astype(np.uint16) if longest < 1 << 16 else left, kind="stable")
        number = np.empty(n_codes, np.int32)
        number[order] = np.arange(n_codes, dtype=np.int32)
        self.first = number[begins]
        # What stands one character further on, for each character of the words in a row.
        behind = np.append(number, np.int32(n_codes))[1:]
        behind[left == 1] = n_codes
        size = len(pieces.weights)
        # For each position where a piece may still go on: its last character in the row of words, and
        # the hash of where it ends. Single characters are looked up once.
        row, by_left, after = order, codes[order], codes + np.uint32(1)
        letters = np.flatnonzero(np.bincount(codes))
        letter_at = np.zeros(int(letters.max(initial=0)) + 1, np.int32)
        letter_at[letters] = pieces.ends_at((letters + 1).astype(np.uint64) * _STEP)
        at, keys = np.arange(n_codes, dtype=np.int32), np.zeros(n_codes, np.uint64)
        starts, ends, ids, weights = [], [], [], []
        single = np.zeros(n_codes, bool)
        for n in range(1, min(pieces.longest, longest) + 1):
            if n > 1:
                short = np.searchsorted(at, cuts[n - 1])
                at, row, keys = at[short:], row[short:] + 1, keys[short:]
            keys = (keys + after[row]) * _STEP
            place = pieces.ends_at(keys) if n > 1 else letter_at[by_left]
            known = np.flatnonzero(place >= 0)
            at, row, keys = at[known], row[known], keys[known]
            found = pieces.ids[place[known]]
            whole = np.flatnonzero(found >= 0)
            begin, found = at[whole], found[whole]
            starts.append(begin)
            ends.append(behind[row[whole]])
            ids.append(found)
            weights.append(pieces.weights[found])
            if n == 1:
                single[begin] = True
        spelt = np.flatnonzero(~single)
        starts.append(spelt)
        ends.append(behind[order[spelt]])
        c = by_left[spelt].astype(np.int64)
        ids.append(np.where(c < 0x80, pieces.byte_ids[np.minimum(c, 0x7F)], size + c))
        n_bytes = 1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000)
        weights.append(n_bytes * pieces.byte_weight)
        # The longest first, as it is the likeliest more often than not. A position begins one edge of a
        # length at most, so that edges have their places without a sort.
        many = np.zeros(n_codes, np.int32)
        for begin in starts:
            many[begin] += 1
        self.begin = np.concatenate([[0], np.cumsum(many)])
        free, n_edges = self.begin[:-1].copy(), int(self.begin[-1])
        self.start = np.repeat(np.arange(n_codes, dtype=np.int32), many)
        self.end, self.ids = np.empty(n_edges, np.int32), np.empty(n_edges, np.int32)
        self.logp, self.upto = np.empty(n_edges), np.empty(n_edges)
        for begin, *edges in zip(starts[::-1], ends[::-1], ids[::-1], weights[::-1]):
            at = free[begin]
            self.end[at], self.ids[at], self.logp[at] = edges
            free[begin] = at + 1
        # Log of the sum over all ways to the end of the word, from the last character backwards.
        rest = np.zeros(n_codes + 1)
        for a, b in zip(cuts[:-1], cuts[1:]):
            group = self.begin[a:b + 1]
            edges, group = slice(group[0], group[-1]), group - group[0]
            of = self.start[edges] - a
            value = self.logp[edges] + rest[self.end[edges]]
            top = np.maximum.reduceat(value, group[:-1])
            share = np.exp(value - top[of])
            total = np.add.reduceat(share, group[:-1])
            rest[a:b] = top + np.log(total)
            self.logp[edges] = value - rest[a:b][of]
            upto = np.cumsum(share / total[of])
            upto -= np.concatenate([[0.0], upto[group[1:-1] - 1]])[of]
            np.minimum(upto, 1.0, out=upto)
            upto[group[1:] - 1] = 1.0
            self.upto[edges] = upto

    def draw(self, position: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An edge from each position, by its conditional probability."""
        edge = self.begin[position]
        on = np.flatnonzero(self.upto[edge] <= u)
        while len(on):
            edge[on] += 1
            on = on[self.upto[edge[on]] <= u[on]]
        return edge


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def counted(key: np.ndarray, *counters, before: int = 0) -> np.ndarray:
    """Keys with counters mixed in, ``before`` of which were so already."""
    for i, c in enumerate(counters, before + 1):
        key = _mixed(key + (np.atleast_1d(c).astype(np.uint64) + np.uint64(i)) * _STEP)
    return key


def uniform(key: np.ndarray, *counters, before: int = 0) -> np.ndarray:
    """Numbers between 0 and 1, neither included, from keys and counters."""
    x = counted(key, *counters, before=before)
    return (np.right_shift(x, np.uint64(12)).astype(float) + 0.5) * 2.0**-52


class Search:
    """The search on some texts at once, given their words in a row and the texts' keys.

    The sets beside a path get their times as far as ``NEAR`` says; those beyond cannot come before
    ``floor``, and get theirs when the earliest set of a text is later than that.
    """

    def __init__(self, lattice: Lattice, words: np.ndarray, text_of: np.ndarray, keys: np.ndarray):
        self.lattice, self.words, self.text_of, self.keys = lattice, words, text_of, keys
        self.first_word = np.searchsorted(text_of, np.arange(len(keys) + 1))
        self.paths: list[dict] = []
        texts = len(keys)
        first = lattice.first[words]
        edges, occ = self._grow(np.arange(len(words)), first, 0)
        time = np.log(-np.log(uniform(keys, _FIRST, 0, 0)))
        self._add(edges, occ, time, np.zeros(texts, np.int64), np.ones(texts, bool))
        self.used: dict[tuple[int, int], list[int]] = {}

    def _grow(self, occ: np.ndarray, position: np.ndarray, sample: int):
        """Edges from positions in words to the words' ends, with the word of each, in order."""
        edges, of, step = [], [], 0
        text = self.text_of[occ]
        keys = counted(self.keys, _GROWTH, sample)[text]
        keys = counted(keys, occ - self.first_word[text], before=2)
        while len(occ):
            e = self.lattice.draw(position, uniform(keys, step, before=3))
            edges.append(e)
            of.append(occ)
            position, step = self.lattice.end[e], step + 1
            on = np.flatnonzero(position != self.lattice.end_of_word)
            occ, position, keys = occ[on], position[on], keys[on]
        # A word that is still there at a step has had an edge at every step before.
        many = np.zeros(len(self.words), np.int64)
        for occ in of:
            many[occ] += 1
        first, grown = np.cumsum(many) - many, np.empty(int(many.sum()), np.int64)
        for step, (occ, e) in enumerate(zip(of, edges)):
            grown[first[occ] + step] = e
        return grown, np.repeat(np.arange(len(many)), many)

    def _add(self, edges, occ, time, fresh, drawn) -> None:
        """A path per text. Sets beside its nodes from ``fresh`` on are its own."""
        bounds = np.searchsorted(occ, self.first_word)
        logp = self.lattice.logp[edges]
        before, total = np.zeros(len(edges)), np.zeros(len(self.keys))
        near, far = bounds[:-1] + fresh, np.where(drawn, bounds[1:], 0)
        floor = np.full(len(self.keys), np.inf)
        # Text by text, so that sums are the same whatever other texts there are.
        for t in np.flatnonzero(bounds[1:] > bounds[:-1]).tolist():
            a, b = int(bounds[t]), int(bounds[t + 1])
            np.cumsum(logp[a:b - 1], out=before[a + 1:b])
            total[t] = before[b - 1] + logp[b - 1]
            own = before[near[t]:far[t]]
            if len(own):
                # Probabilities only fall along a path.
                n = int(np.searchsorted(-own, NEAR - own[0], side="right"))
                if n < len(own):
                    far[t], floor[t] = near[t] + n, LEAST_WAIT - own[n]
        path = {
            "edges": edges, "occ": occ, "bounds": bounds, "time": time, "logp": total, "before": before,
            "beside": np.full(len(edges), np.inf), "drawn": drawn, "far": far, "floor": floor,
            "keys": counted(self.keys, _WAIT, len(self.paths)),
        }
        self._wait(path, np.arange(len(self.keys)), near, far)
        self.paths.append(path)

    def _wait(self, path: dict, text: np.ndarray, begin: np.ndarray, end: np.ndarray) -> None:
        """Draw the times of the sets beside some texts' nodes, from ``begin`` up to ``end``."""
        many = np.maximum(end - begin, 0)
        text = np.repeat(text, many)
        node = np.arange(len(text)) + np.repeat(begin - np.cumsum(many) + many, many)
        edge, before = path["edges"][node], path["before"][node]
        with np.errstate(divide="ignore"):
            # A lone edge has all probability, but for rounding.
            start = self.lattice.start[edge]
            lone = self.lattice.begin[start + 1] - self.lattice.begin[start] == 1
            mass = np.where(
                lone, -np.inf, before + np.log(np.maximum(-np.expm1(self.lattice.logp[edge]), 0))
            )
        wait = np.log(-np.log(uniform(path["keys"][text], node - path["bounds"][text], before=2)))
        path["beside"][node] = np.where(
            np.isfinite(mass), np.logaddexp(path["time"][text], wait - mass), np.inf
        )

    def _best(self, path: dict) -> tuple[np.ndarray, np.ndarray]:
        """The earliest set beside a path, per text: its time and its node."""
        bounds, beside = path["bounds"], np.append(path["beside"], np.inf)
        filled = bounds[1:] > bounds[:-1]
        low = np.where(filled, np.minimum.reduceat(beside, bounds[:-1]), np.inf)
        text = np.repeat(np.arange(len(self.keys)), np.diff(bounds))
        hit = np.flatnonzero(beside[:-1] == low[text])
        node = np.zeros(len(self.keys), np.int64)
        node[text[hit[::-1]]] = hit[::-1]
        return low, node

    def next_times(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text, the time of the earliest set on the agenda, its path and node."""
        low, nodes = map(np.array, zip(*map(self._best, self.paths)))
        for nth, path in enumerate(self.paths):
            late = np.flatnonzero(np.isfinite(path["floor"]) & (low.min(0) >= path["floor"]))
            if len(late):
                self._wait(path, late, path["far"][late], path["bounds"][late + 1])
                path["floor"][late] = np.inf
                low[nth], nodes[nth] = self._best(path)
        path = low.argmin(0)
        every = np.arange(len(self.keys))
        return low[path, every], path, nodes[path, every]

    def more(self) -> None:
        """The next sample of every text that has one."""
        time, path, node = self.next_times()
        lattice, sample, texts = self.lattice, len(self.paths), len(self.keys)
        drawn = np.isfinite(time)
        u = uniform(self.keys, _BRANCH, sample)
        wait = np.log(-np.log(uniform(self.keys, _AGAIN, sample)))
        kept_edges, kept_occ, go_occ, go_pos = [], [], [], []
        fresh = np.zeros(texts, np.int64)
        for t in np.flatnonzero(drawn).tolist():
            p, n = self.paths[path[t]], int(node[t])
            edge, own = int(p["edges"][n]), int(p["bounds"][t])
            used = self.used.setdefault((int(path[t]), n), [edge])
            at = lattice.start[edge]
            row = np.arange(lattice.begin[at], lattice.begin[at + 1])
            row = row[[e not in used for e in row.tolist()]]
            share = np.exp(lattice.logp[row])
            upto = np.cumsum(share)
            pick = int(np.searchsorted(upto, u[t] * upto[-1], side="right"))
            other = int(row[min(pick, len(row) - 1)])
            used.append(other)
            left = upto[-1] - share[min(pick, len(row) - 1)]
            p["beside"][n] = (
                np.logaddexp(time[t], wait[t] - p["before"][n] - np.log(left))
                if len(row) > 1 and left > 0 else np.inf
            )
            occ = int(p["occ"][n])
            kept_edges.append(np.append(p["edges"][own:n], other))
            kept_occ.append(np.append(p["occ"][own:n], occ))
            fresh[t] = n - own + 1
            if lattice.end[other] != lattice.end_of_word:
                go_occ.append(np.array([occ]))
                go_pos.append(lattice.end[[other]])
            later = np.arange(occ + 1, self.first_word[t + 1])
            go_occ.append(later)
            go_pos.append(lattice.first[self.words[later]])
        none = np.empty(0, np.int64)
        joined = lambda parts: np.concatenate([none, *parts])
        edges, occ = self._grow(joined(go_occ), joined(go_pos), sample)
        edges = np.concatenate([joined(kept_edges), edges])
        occ = np.concatenate([joined(kept_occ), occ])
        order = np.argsort(occ, kind="stable")  # what was kept of a word stands before what grew
        self._add(edges[order], occ[order], time, fresh, drawn)


def words_in(normal: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct words of some texts, the number of each word in a row, and the text it is of.

    A word is what stands up to the next blank, with all blanks in front of it; blanks at the end of
    a text are a word, too.
    """
    lists = pc.split_pattern(pa.array(normal, pa.large_string()), SPACE)
    begin = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    encoded = lists.flatten().dictionary_encode()
    parts = encoded.dictionary
    code = encoded.indices.to_numpy().astype(np.int64)
    text = np.repeat(np.arange(len(normal)), np.diff(begin))
    # An empty part stands between two blanks, or at an end of the text.
    ends = np.zeros(len(code), bool)
    ends[begin[1:] - 1] = True
    empty = (pc.binary_length(parts).to_numpy() == 0)[code]
    first = np.zeros(len(code), bool)
    first[begin[:-1]] = True
    at = np.flatnonzero(~empty | (ends & ~first))
    # As many blanks as parts since the word before, or since the first part of the text.
    since = begin[text[at]]
    since[1:] = np.maximum(since[1:], at[:-1])
    number, distinct = pd.factorize((at - since) * len(parts) + code[at])
    blanks, of = np.divmod(distinct, max(len(parts), 1))
    parts = parts.to_numpy(zero_copy_only=False)
    index = [SPACE * b + p for b, p in zip(blanks.tolist(), parts[of].tolist())]
    return index, number.astype(np.int64), text[at]


def sampled(
    texts: list[str], keys: np.ndarray, model, pieces: Pieces, k: int, normal: list[str] | None = None
) -> list[list[tuple]]:
    """Per text, which may be given as ``normal``ised by the model already, up to ``k`` of ``(ids, log probability, gumbel, log inclusion)``, the largest gumbel first."""
    normal = [model.normalize(t) for t in texts] if normal is None else normal
    index, words, text_of = words_in(normal)
    search = Search(Lattice(index, pieces), words, text_of, keys)
    for _ in range(k - 1):
        search.more()
    left_out = search.next_times()[0]
    found: list[list[tuple]] = [[] for _ in normal]
    for path in search.paths:
        ids = search.lattice.ids[path["edges"]]
        size = len(pieces.weights)
        with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
            rate = path["logp"] + left_out
            inclusion = np.where(rate < -30, rate, np.log(-np.expm1(-np.exp(rate))))
        for t in np.flatnonzero(path["drawn"]).tolist():
            own = ids[path["bounds"][t]:path["bounds"][t + 1]]
            if len(own) and own.max() >= size:
                own = _spelt(own, pieces)
            found[t].append((
                own.astype("<u4").tobytes(), float(path["logp"][t]), -float(path["time"][t]),
                0.0 if np.isinf(left_out[t]) else float(inclusion[t]),
            ))
    return found


def _spelt(ids: np.ndarray, pieces: Pieces) -> np.ndarray:
    size, out = len(pieces.weights), []
    for i in ids.tolist():
        out += [i] if i < size else pieces.byte_ids[list(chr(i - size).encode())].tolist()
    return np.array(out, np.int64)


@functools.lru_cache(maxsize=1)
def loaded(model_file: str, changed: int, sharpness: float):
    """A model and its pieces, for all tasks of a worker until the file is another or has ``changed``."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    return model, Pieces.of(model, sharpness)


def row_key(key: object) -> int:
    return xxhash.xxh64_intdigest(repr(key).encode(), SEED)


def sample_segmentations(
    table: DataFrame, model_file: str, *, k: int = SAMPLES, sharpness: float = SHARPNESS,
    id_column: str = "doc_id", text: str = "text", round_trip: bool = False,
) -> DataFrame:
    """``doc_id, sample, ids, log_prob, gumbel, log_inclusion`` per row of ``table`` and sample, from 1.

    ``ids`` are little-endian unsigned 32-bit numbers in one binary value. A text with fewer than
    ``k`` segmentations gives all of them, each included with certainty. A null text counts as empty, and an
    empty text has one segmentation, of no pieces. The id is the key of the random numbers: rows of
    one id and text get the same samples, a null id is a key of its own. Other columns are not
    looked at; an empty table gives no rows. With ``round_trip`` there are two more columns,
    ``text_crc32`` of the text as the model normalises it and ``decoded_crc32`` of the decoded sample.
    """
    rows = table.select(col(id_column).alias("doc_id"), col(text).cast("string").alias("text"))
    names = ["doc_id", "sample", "ids", "log_prob", "gumbel", "log_inclusion"]
    kinds = [pa.int32(), pa.binary(), pa.float64(), pa.float64(), pa.float64()]
    if round_trip:
        names += ["text_crc32", "decoded_crc32"]
        kinds += [pa.int64(), pa.int64()]

    def sample(batches):
        model, pieces = loaded(model_file, os.stat(model_file).st_mtime_ns, sharpness)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            keys = np.array([row_key(i) for i in batch.column(0).to_pylist()], np.uint64)
            ends = np.cumsum([len(t) for t in texts])
            cuts = np.flatnonzero(np.diff(ends // BATCH_CHARS)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)]):
                normal = [model.normalize(t) for t in texts[a:b]]
                out = [
                    (a + t, nth, *one)
                    for t, own in enumerate(sampled(texts[a:b], keys[a:b], model, pieces, k, normal))
                    for nth, one in enumerate(own, 1)
                ]
                if round_trip:
                    sums = [zlib.crc32(plain(t).encode()) for t in normal]
                    back = decoded([o[2] for o in out], pieces.texts)
                    out = [(*o, sums[o[0] - a], zlib.crc32(t.encode())) for o, t in zip(out, back)]
                ids = batch.column(0).take(pa.array([o[0] for o in out], pa.int32()))
                found = [pa.array([o[i + 1] for o in out], t) for i, t in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([ids, *found], names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, sample int, ids binary, log_prob double, gumbel double, log_inclusion double"
    if round_trip:
        schema += ", text_crc32 bigint, decoded_crc32 bigint"
    return rows.mapInArrow(sample, schema)


def plain(normal: str) -> str:
    """What a text comes back as after encoding and decoding, from its normalised form: without the
    blank in front."""
    return normal.replace(SPACE, " ").removeprefix(" ")


def decoded(rows: list[bytes], texts: pa.LargeBinaryArray) -> list[str]:
    """The texts of some rows of ids; the blank that encoding puts in front is taken off."""
    joined = texts.take(pa.array(np.frombuffer(b"".join(rows), "<u4")))
    _, offsets, data = joined.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(joined) + 1, joined.offset * 8)
    cuts = offsets[np.cumsum([0, *(len(r) // 4 for r in rows)])].tolist()
    view = memoryview(data or b"")
    return [str(view[a:b], "utf-8", "replace").removeprefix(" ") for a, b in zip(cuts[:-1], cuts[1:])]


def decode(
    table: DataFrame, model_file: str, *, ids: str = "ids", into: str = "decoded"
) -> DataFrame:
    """The table with the text of its ``ids`` in a column ``into``, null where they are null."""

    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import sentencepiece

        texts = piece_texts(sentencepiece.SentencePieceProcessor(model_file=model_file))
        for part in parts:
            yield part.map(lambda i: None if i is None else decoded([bytes(i)], texts)[0])

    return table.withColumn(into, run(col(ids)))
