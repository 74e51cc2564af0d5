import hashlib
import random
from collections import defaultdict

import pytest

from eventpulse.llm import chat_trees as ct, queries

COLUMNS = "conv_id bigint, turn bigint, role string, text string"
TALK = queries.CONTROL_TALK


def expected(rows):
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        talks[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    out = {}
    for conv, turns in talks.items():
        turns.sort(key=lambda t: t[0])
        learnt = "".join(t for _, r, t in turns if r == "assistant")
        out[conv] = (
            len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest(),
            len(learnt), hashlib.sha256(learnt.encode()).hexdigest(),
        )
    return out


def table(spark, rows, parts=3):
    return spark.createDataFrame(rows, COLUMNS).repartition(parts).selectExpr(
        "*", "1 AS piece", "2 AS block", "3 AS h1", "'x' AS conv", "4 AS row_no"
    )


def read(forest):
    got = {}
    for r in ct.digests(ct.read_back(forest)).collect():
        assert r.conv_id not in got
        got[r.conv_id] = (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256)
        assert r.formatted_chars > 0
    return got


def brute_nodes(rows):
    """Distinct beginnings of conversations, with their characters."""
    talks = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        talks[conv].append((role or "", text or ""))
    return {tuple(t[:i + 1]) for t in talks.values() for i in range(len(t))}


def talks(seed, n=60):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, 7)):
            role = ["user", "assistant"][turn % 2] if rng.random() < 0.9 else rng.choice(["system", "tool", "", None])
            rows.append((conv, turn, role, rng.choice(["hi", "yes", "no", None])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_shared_turns_come_once_and_are_seen_by_their_conversations_only(spark, seed):
    rows = talks(seed)
    forest = ct.prefix_forest(table(spark, rows))
    assert read(forest) == expected(rows)
    nodes = sorted(map(tuple, forest.nodes.select("start", "length", "position", "visible_to", "piece", "block").collect()))
    assert len(nodes) == len(brute_nodes(rows))
    at = 0
    for start, length, *_ in nodes:  # gapless
        assert start == at
        at += length
    # Depth-first: what sees a node lies behind it without a gap, and positions follow the ancestors.
    open_nodes = []
    for start, length, position, visible_to, piece, block in nodes:
        while open_nodes and open_nodes[-1][1] <= start:
            open_nodes.pop()
        assert position == sum(n for n, _ in open_nodes)
        assert not open_nodes or visible_to <= open_nodes[-1][1]
        open_nodes.append((length, visible_to))
    # The intervals of a block are its ancestors' places.
    for b in forest.blocks.collect():
        want = {x[5] for x in nodes if x[0] <= b.block < x[3]}
        assert [a.start for a in b.attends] == sorted(want) and b.attends[0].start == b.tree
        assert all(a.stop == a.start + sum(x[1] for x in nodes if x[5] == a.start) for a in b.attends)


def test_each_learnt_text_is_masked(spark):
    forest = ct.prefix_forest(table(spark, talks(3)))
    for n in forest.nodes.collect():
        role, text = ct.read_turn(n.piece)
        assert (n.loss_start is not None) == (role == "assistant")
        if role == "assistant":
            assert ct.unescaped(n.piece[n.loss_start:n.loss_end]) == text


def test_a_conversation_may_reach_over_partitions(spark):
    rng = random.Random(4)
    rows = [(5, t, rng.choice(["user", "assistant"]), rng.choice("ab")) for t in range(3000)]
    rows += [(6, t, r, x) for _, t, r, x in rows[:2000]] + [(c, t, r, x) for c in (1, 9) for _, t, r, x in rows[:7]]
    rows += [(c, 7, "user", f"other {c}") for c in (1, 9)]
    forest = ct.prefix_forest(table(spark, rows, 6))
    assert read(forest) == expected(rows)
    assert forest.nodes.count() == len(brute_nodes(rows)) == 3002


def test_a_comb_of_branches(spark):
    trunk = [("user" if i % 2 else "assistant", f"t{i}") for i in range(40)]
    rows = [(c, t, *turn) for c in range(40) for t, turn in enumerate(trunk[:c] + [("user", f"leaf {c}")])]
    forest = ct.prefix_forest(table(spark, rows))
    assert read(forest) == expected(rows)
    assert forest.nodes.count() == 79


def test_edge_cases(spark):
    long = "😀" * 200_000 + "[INST]"
    rows = [
        (None, 1, "user", "a"), (None, 2, None, None), (1, None, "user", "first"), (1, 1, "assistant", "second"),
        (2, 1, "user", "same"), (2, 1, "user", "same"), (3, 0, "", ""), (4, 0, "assistant", long),
        (5, 0, "a</role>\\ b", "\\0 \\\\ </s> <<SYS>> <<s> <</s> [/INST] </turn>\n"),
        (6, 0, "assistant", "\\"), (7, 0, "assistant", "</s"), (7, 1, "user", ">"), (8, 0, "user ", " x "),
    ]
    assert read(ct.prefix_forest(table(spark, rows))) == expected(rows)
    pieces = [r.piece for r in ct.prefix_forest(table(spark, rows)).nodes.collect()]
    for p in pieces:
        opening = p[:p.index(" ")] if not p.startswith(ct.OTHER) else p[:p.index(ct.ROLE) + len(ct.ROLE)]
        body = p[len(opening):p.rindex(" ")]
        assert not any(c in body for c in ct.CONTROLS)


def test_empty_table(spark):
    forest = ct.prefix_forest(table(spark, []))
    assert forest.nodes.count() == forest.blocks.count() == 0 and read(forest) == {}


def test_query_on_the_driver_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", TALK), (-1, 1, "assistant", TALK)]
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256)
           for r in queries.op13_chat_trees(spark, sf_dir).collect()}
    assert got == expected(rows)
