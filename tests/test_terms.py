import re
import time

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from eventpulse.operators import patterns, terms as terms_module
from eventpulse.operators.terms import (
    LITERAL, PER_POST, PER_TERM, TermSet, compile_terms, drop_copies, flag_posts, matched_timestamps,
)


def like(text, term, literal=False):
    """Whether ``text LIKE '% term %'``, by hand."""
    if text is None or term is None:
        return False
    if literal:
        return f" {term} " in text
    body, i = "", 0
    while i < len(term):
        if term[i] == "\\" and term[i + 1:i + 2] in ("%", "_", "\\") and i + 1 < len(term):
            body += re.escape(term[i + 1])
            i += 1
        else:
            body += {"%": ".*", "_": "."}.get(term[i], re.escape(term[i]))
        i += 1
    return re.search(f" {body} ", text, re.S) is not None


TEXTS = [
    "you are an idiot today", "idiot at the start", "ends with idiot", "an idiot, with comma",
    "an Idiot here", "an idiot and an idiot here", "an idiot and a clown here", "two  spaces here",
    "out of the blue now", "of the start", "at the end of the", "a st pid b", "so stXpid a", None,
    "", " ", "  ", " idiot ", "line\nbreak idiot here", "a 100% sure b", "a 100x sure b",
    "back a\\b slash", "back a\\ slash", "x under_score y", "x underXscore y", "é idiot ü",
    "it's don't go", "emoji \U0001f600 x",
]
LISTS = {
    "words": ["idiot", "clown", None],
    "phrases": ["of the", "end of the", "an idiot and"],
    "empty": ["", "nothing"],
    "wildcards": ["st_pid", "id%t", "100%", "under_score", "\\%"],
    "backslash": ["a\\b", "a\\", "a\\\\b", "100\\% sure"],
    "quotes": ["don't", "it's don't", "\U0001f600"],
    "many words": ["idiot", *[f"word{i}" for i in range(100)]],
    "many phrases": ["of the", "an idiot", *[f"two words{i}" for i in range(20)], "a b c d e"],
    "none": [],
}


@pytest.mark.parametrize("limit", [10_000, 0], ids=["plan", "join"])
@pytest.mark.parametrize("literal", [False, True], ids=["like", "literal"])
@pytest.mark.parametrize("name", LISTS)
def test_flags_by_brute_force(spark, posts_of, terms_of, name, literal, limit):
    values = LISTS[name]
    posts = posts_of(*[(t, str(i)) for i, t in enumerate(TEXTS)])
    want = {(i, v) for i, t in enumerate(TEXTS) for v in values if like(t, v, literal)}
    options = {"mode": LITERAL if literal else "like", "max_terms": limit}
    pairs = flag_posts(posts, terms_of(*values), multiplicity=PER_TERM, **options).collect()
    assert sorted((int(r.timestamp_ms), r.term) for r in pairs) == sorted(want)
    kept = flag_posts(posts, terms_of(*values), **options).collect()
    assert sorted(int(r.timestamp_ms) for r in kept) == sorted({i for i, _ in want})


WORD = st.sampled_from(["a", "b", "the", "of", "", "a_b", "%", "_"])


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    texts=st.lists(st.lists(WORD, min_size=1, max_size=7).map(" ".join), min_size=1, max_size=40),
    terms=st.lists(st.lists(WORD, min_size=1, max_size=3).map(" ".join), min_size=1, max_size=12),
)
def test_words_equal_like_join(spark, posts_of, terms_of, texts, terms):
    posts = posts_of(*[(t, str(i)) for i, t in enumerate(texts)])
    listed = terms_of(*terms)
    joined = posts.join(listed, F.expr("text LIKE concat('% ', term, ' %')"))
    for limit, broadcast in ((10_000, 0), (0, 10_000), (0, 0)):
        got = flag_posts(
            posts, listed, multiplicity=PER_TERM, max_terms=limit, broadcast_terms=broadcast
        )
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, joined.collect()))


@pytest.mark.parametrize("limit", [10_000, 0])
def test_per_term_has_columns_of_both_sides_and_repeated_terms(spark, posts_of, limit):
    posts = posts_of(("an idiot here", "1"), ("a clown here", "2"))
    terms = spark.createDataFrame(
        [("idiot", "x"), ("idiot", "y"), ("clown", "z")], "term string, group string"
    )
    got = flag_posts(posts, terms, multiplicity=PER_TERM, max_terms=limit)
    assert got.columns == ["text", "timestamp_ms", "term", "group"]
    assert sorted((r.timestamp_ms, r.group) for r in got.collect()) == [
        ("1", "x"), ("1", "y"), ("2", "z")
    ]
    twice = flag_posts(posts, terms.select("term"), multiplicity=PER_TERM, max_terms=limit)
    assert twice.count() == 3
    assert flag_posts(posts, terms, max_terms=limit).count() == 2


@pytest.mark.parametrize("limit", [10_000, 0])
def test_copies_stay_until_dropped(posts_of, terms_of, limit):
    posts = posts_of(*[("an idiot here", "1")] * 50, ("an idiot here", "2"), ("no match", "3"))
    flagged = flag_posts(posts, terms_of("idiot"), max_terms=limit)
    assert flagged.count() == 51
    assert sorted(map(tuple, drop_copies(flagged).collect())) == [
        ("an idiot here", "1"), ("an idiot here", "2")
    ]


WILD = [
    "st_pid", "id%t", "100%", "%", "_", "%less", "wor%less", "of t_e", "a\\%b", "a\\b", "c\\\\d", "%x%", "\0", "e\0f",
    "", "a  b", "very%long%pattern of words", "un_erscore", "z" * 20 + "%",
]
WILD_TEXTS = [
    "a stupid b", "st pid", " st pid ", "x idiot y", "an id or t here", " 100% ", " 1000 of ", " less ", " a worthless b",
    " of the ", " a%b ", " a\\b ", " c\\d ", " c\\\\d ", "  ", " ", "", " e\0f ", " a  b ", " very x long y pattern of words z",
    " underscore ", " " + "z" * 25 + " ", "axa x b", " \0 ",
]


@pytest.mark.parametrize("mode", ["like", "literal"])
@pytest.mark.parametrize("broadcast", [10_000, 0])
def test_wildcards_by_index_equal_a_list_in_the_plan(posts_of, terms_of, mode, broadcast):
    posts, terms = posts_of(*[(t, str(i)) for i, t in enumerate(WILD_TEXTS)]), terms_of(*WILD)
    want = {(t, w) for t in WILD_TEXTS for w in WILD if like(t, w, mode == LITERAL)}
    got = flag_posts(
        posts, terms, multiplicity=PER_TERM, mode=mode, max_terms=0, broadcast_terms=broadcast
    ).collect()
    assert {(r.text, r.term) for r in got} == want and len(got) == len(want)
    kept = flag_posts(posts, terms, mode=mode, max_terms=0, broadcast_terms=broadcast).collect()
    assert {r.text for r in kept} == {t for t, _ in want}


INNER = st.text(alphabet="ab%_\\ é", min_size=0, max_size=9)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    texts=st.lists(st.text(alphabet="aab é%\\_", max_size=40), min_size=1, max_size=30),
    terms=st.lists(INNER, min_size=1, max_size=12, unique=True),
    grams=st.sampled_from([0, 10_000]), count_from=st.sampled_from([1, 256]),
    chunk=st.sampled_from([3, 1 << 16]),
)
def test_wildcards_inside_words_equal_like(posts_of, terms_of, texts, terms, grams, count_from, chunk):
    posts = posts_of(*[(t, str(i)) for i, t in enumerate(texts)])
    want = sorted((i, w) for i, t in enumerate(texts) for w in terms if like(t, w))
    with pytest.MonkeyPatch.context() as patch:
        for name, value in (("PLAN_GRAMS", grams), ("COUNT_FROM", count_from), ("CHUNK_CHARS", chunk)):
            patch.setattr(patterns, name, value)
        for limit, broadcast in ((0, 10_000), (0, 0), (10_000, 0)):
            got = flag_posts(
                posts, terms_of(*terms), multiplicity=PER_TERM, max_terms=limit,
                broadcast_terms=broadcast,
            ).collect()
            assert sorted((int(r.timestamp_ms), r.term) for r in got) == want


def test_every_term_with_three_letters_in_a_row_has_a_key(terms_of):
    terms = terms_of("%abc%", "%a_abcd%", "a%xyz%b", "%xyzzy%pl", "%", "_", "%ab%", "%é%").select(
        F.col("term").alias("_term")
    )
    best = {r._term: r._best for r in patterns.indexed(terms, False).collect()}
    assert best["%abc%"] == ["~abc"] and best["%a_abcd%"] == ["~abc", "~bcd"]
    assert best["a%xyz%b"] == ["~xyz"] and best["%xyzzy%pl"] == ["~xyz", "~yzz", "~zzy", ">pl"][:3] + [">pl"]
    assert best["%"] == best["_"] == [] and best["%ab%"] == ["~ab"] and best["%é%"] == ["~é"]


@pytest.mark.parametrize("limit", [10_000, 0])
def test_many_wildcards_in_long_texts_take_linear_time(spark, posts_of, limit):
    """Backtracking tries all places of all parts: here some 10**15."""
    posts = posts_of((" " + "ab" * 60_000 + " ", "1"), ("x " + "ab " * 100, "2"))
    terms = spark.createDataFrame([("%a%a%a%b%c%",), ("%b%ba%ab%",), ("%_a%_b%ca%",)], "term string")
    began = time.monotonic()
    got = flag_posts(posts, terms, multiplicity=PER_TERM, max_terms=limit).collect()
    assert sorted((r.timestamp_ms, r.term) for r in got) == [("1", "%b%ba%ab%")]
    assert time.monotonic() - began < 30


def test_ten_thousand_wildcards_do_not_crash(spark, posts_of):
    posts = posts_of(("a word7 b", "1"), ("a other b", "2"))
    terms = spark.range(10_001).selectExpr("concat('wo_d', id) AS term")
    assert [r.term for r in flag_posts(posts, terms, multiplicity=PER_TERM).collect()] == ["wo_d7"]
    long = terms.limit(1).selectExpr("concat(repeat('x', 1200), '%') AS term")
    assert flag_posts(posts, long).count() == 0


def test_timestamps_are_written_as_read(posts_of, terms_of):
    flagged = flag_posts(posts_of((" x ", "soon"), (" x ", None), (" y ", "1")), terms_of("x"))
    rows = matched_timestamps(flagged)
    assert rows.columns == ["Timestamp"]
    assert [r.Timestamp for r in rows.collect()] == ["soon", None]


def test_list_beyond_the_bound_is_not_compiled(spark, terms_of):
    assert compile_terms(terms_of("a", "b"), max_terms=1) is None
    assert compile_terms(terms_of("a" * 1001)) is None
    assert isinstance(compile_terms(terms_of("a" * 1000, None)), TermSet)


def test_flagging_is_a_filter_below_the_join(spark, posts_of, terms_of):
    posts = posts_of(("a", "1")).join(spark.range(5), F.col("timestamp_ms") == F.col("id"))
    plan = flag_posts(posts, terms_of("idiot", "of the"))._jdf.queryExecution().optimizedPlan()
    text = plan.toString()
    assert text.index("Join") < text.index("arrays_overlap")
    assert text.count("Join") == 1


def test_unknown_options_are_refused(posts_of, terms_of):
    with pytest.raises(ValueError):
        flag_posts(posts_of(("a", "1")), terms_of("a"), multiplicity="twice")
    with pytest.raises(ValueError):
        flag_posts(posts_of(("a", "1")), terms_of("a"), mode="regex")


@pytest.mark.parametrize("multiplicity", [PER_POST, PER_TERM])
def test_a_long_list_is_met_without_shuffling_words(spark, posts_of, monkeypatch, multiplicity):
    """Beyond 100,000 terms every word of every text used to be shuffled, and then every match."""
    monkeypatch.setattr(terms_module, "BLOCK_TERMS", 60_000)
    posts = posts_of(
        ("a w1_ w2 w2 w149999 b", "1"), ("a w1_ w2 w2 w149999 b", "1"), ("w1 w7", "2"), ("a x y z", "3"),
        (None, "4"), ("a on w5 b", "5"),
    )
    terms = spark.range(150_000).selectExpr("concat('w', id) AS term").unionAll(
        spark.createDataFrame([("z",), ("w2_",), ("wx_",), ("_2",), ("o_",), (None,)], "term string")
    )
    found = flag_posts(posts, terms, multiplicity=multiplicity)
    if multiplicity == PER_POST:
        assert sorted(r.timestamp_ms for r in found.collect()) == ["1", "1", "5"]
        return
    assert sorted((r.timestamp_ms, r.term) for r in found.collect()) == sorted(
        2 * [("1", "w2"), ("1", "w149999"), ("1", "_2")] + [("5", "o_"), ("5", "w5")]
    )
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "_digest" not in plan and "_salt" not in plan


def test_a_repeated_term_of_a_long_list_counts_each_time(spark, posts_of):
    terms = spark.range(20_000).selectExpr("concat('w', id DIV 2) AS term")
    found = flag_posts(posts_of(("a w3 b", "1")), terms, multiplicity=PER_TERM, max_terms=10)
    assert [r.term for r in found.collect()] == ["w3", "w3"]


def test_masked_terms_alone_need_no_index_of_parts(spark, posts_of, monkeypatch):
    """All texts used to be looked through for the parts of no terms at all."""
    monkeypatch.setattr(terms_module, "meet_patterns", lambda *_: pytest.fail("no term has parts"))
    terms = spark.range(50).selectExpr("concat('w_rd', id) AS term")
    found = flag_posts(posts_of(("a word7 wird7 b", "1")), terms, multiplicity=PER_TERM)
    assert [r.term for r in found.collect()] == ["w_rd7"]


def test_texts_with_many_terms_go_to_the_join_once(spark, posts_of):
    """Every match of a text used to be shuffled to find out that it has one."""
    terms = spark.range(50).selectExpr("concat('w_rd', id) AS term")
    posts = posts_of(("a word7 wird8 word9 b", "1"), ("a word7 wird8 word9 b", "2"), ("c", "3"))
    found = flag_posts(posts, terms)
    assert sorted(r.timestamp_ms for r in found.collect()) == ["1", "2"]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    semi = plan[plan.index("LeftSemi"):]
    assert "Aggregate [_digest" in semi
