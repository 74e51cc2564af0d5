"""The operators on the driver tables, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventpulse.llm import chat_trees
from eventpulse.llm.exact_dedup import exact_groups
from eventpulse.llm import gumbel_pieces, language_id, spelling_variants
from eventpulse.llm.hash_forest import nearest_neighbours
from eventpulse.llm.license_scan import license_scan
from eventpulse.llm.line_dedup import MIN_WORDS, delete_repeated_runs
from eventpulse.llm.packing import pack_documents
from eventpulse.llm.periodic_runs import periodic_runs
from eventpulse.llm.secret_scan import by_kind, find_secrets
from eventpulse.llm.simhash import hex16, near_duplicates
from eventpulse.llm.url_filter import ALLOW, BLOCK, Rule, judge_urls


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def op1_gumbel_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of every document, each decoded again."""
    docs = table(spark, sf_dir, "documents")
    model = public_tokenizers.path("piece_bpe_32k.model")
    return gumbel_pieces.sample_segmentations(docs, model, round_trip=True).select(
        "doc_id", "sample", (F.octet_length("ids") / 4).cast("bigint").alias("n_pieces"),
        F.crc32("ids").alias("ids_crc32"), "log_prob", "gumbel", "log_inclusion", "text_crc32",
        "decoded_crc32",
    )


def held_out(doc_id: str = "doc_id") -> Column:
    """The fold that language models must not learn from."""
    return F.crc32(F.col(doc_id).cast("string")) % 4 == 2


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(~F.coalesce(held_out(), F.lit(False))))
    found = language_id.predict(model, docs)
    return found.select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score",
        "entropy", "rejected",
    )


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
EXACT_DEDUP_SQL = (
    f"WITH n AS (SELECT doc_id, {_LOWER} AS t FROM documents), "
    "g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t) "
    "SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, "
    "sha256(n.t) AS text_sha256 FROM n JOIN g ON g.t = n.t"
)


URL_RULES = (
    Rule("com/", ALLOW), Rule("example.com/en/", BLOCK), Rule("www.example.com/en/", ALLOW),
    Rule("net/es/", BLOCK), Rule("net/fr/", BLOCK),
)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scan = license_scan(table(spark, sf_dir, "documents"))
    words = F.transform("places", lambda p: p["word"])
    base = F.coalesce(F.transform("places", lambda p: p["label"]), F.array().cast("array<string>"))
    more = F.coalesce(F.transform("found", lambda f: f["label"]), F.array().cast("array<string>"))
    weights = F.coalesce(F.transform("found", lambda f: f["weight"]), F.array().cast("array<double>"))
    named = F.when(F.size(base) > 0, F.lit(0.6)).otherwise(F.lit(0.0))
    return scan.select(
        "doc_id", "n_words", F.size(base).cast("bigint").alias("n_base"),
        F.array_min(words).alias("first_word"), F.array_max(words).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, more)), ",").alias("labels"),
        F.greatest(named, F.coalesce(F.array_max(weights), F.lit(0.0))).alias("score"),
    )


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "literal")
    return found.select(
        "doc_id", by_kind("assign").alias("n_assign"), by_kind("access").alias("n_access"),
        by_kind("hex").alias("n_hex"), F.sha2(_spans_text(base), 256).alias("base_sha256"),
        _spans_text(F.col("spans")).alias("spans"),
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    sizes = docs.withColumn("n_lines", F.size(F.split("text", "\n", -1)).cast("bigint"))
    return delete_repeated_runs(sizes).select(
        "doc_id", F.greatest("n_lines", F.lit(0)).alias("n_lines"),
        F.expr("aggregate(deleted_runs, 0L, (n, r) -> n + r.n_lines)").alias("n_deleted"),
        F.array_join(F.transform(
            "deleted_runs", lambda r: F.concat_ws("+", r["first_line"], r["n_lines"])
        ), ",").alias("runs"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )


# Every line of a later copy lies in a shortest run that counts, beginning or ending with it.
LINE_DEDUP_SQL = f"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, generate_subscripts(ls, 1) AS i, unnest(ls) AS line FROM d),
w AS (SELECT doc_id, i, line, len(regexp_extract_all(line, '[^ \t\n\x0B\f\r]+')) AS n FROM l),
c AS (SELECT doc_id, i, line, n, sum(n) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM w),
f AS (SELECT a.doc_id, a.i AS s, min(b.i) AS e FROM c a JOIN c b ON b.doc_id = a.doc_id AND b.i >= a.i
      AND b.upto - a.upto + a.n >= {MIN_WORDS} GROUP BY 1, 2),
b AS (SELECT a.doc_id, max(b.i) AS s, a.i AS e FROM c a JOIN c b ON b.doc_id = a.doc_id AND b.i <= a.i
      AND a.upto - b.upto + b.n >= {MIN_WORDS} GROUP BY 1, 3),
r AS (SELECT x.*, array_to_string(list_slice(d.ls, x.s, x.e), chr(10)) AS body
      FROM (SELECT * FROM f UNION SELECT * FROM b) x JOIN d ON d.doc_id = x.doc_id),
o AS (SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, s) AS nth FROM r),
g AS (SELECT DISTINCT c.doc_id, c.i FROM c JOIN o ON o.doc_id = c.doc_id AND c.i BETWEEN o.s AND o.e
      WHERE o.nth > 1),
k AS (SELECT doc_id, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS island, i FROM g),
m AS (SELECT doc_id, min(i) - 1 AS first, count(*) AS n FROM k GROUP BY doc_id, island),
u AS (SELECT doc_id, string_agg(first || '+' || n, ',' ORDER BY first) AS runs, sum(n) AS n
      FROM m GROUP BY doc_id),
t AS (SELECT c.doc_id, string_agg(c.line, chr(10) ORDER BY c.i) AS text FROM c
      LEFT JOIN g ON g.doc_id = c.doc_id AND g.i = c.i WHERE g.i IS NULL GROUP BY c.doc_id)
SELECT x.doc_id, CAST(coalesce(len(d.ls), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(u.n, 0) AS BIGINT) AS n_deleted, coalesce(u.runs, '') AS runs,
       sha256(coalesce(t.text, '')) AS text_sha256
FROM documents x LEFT JOIN d ON d.doc_id = x.doc_id LEFT JOIN u ON u.doc_id = x.doc_id
LEFT JOIN t ON t.doc_id = x.doc_id"""


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return found.select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")


def tokenizer_file() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_file(), keep_ids=False)


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def _repeated_in_places(docs: DataFrame) -> DataFrame:
    """The documents with a repeated stretch of words put into every tenth, by the hash of its id."""
    words = docs.select(
        "doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"),
        F.array_remove(F.split("text", r"[\x20\x09-\x0D]+", -1), "").alias("words"),
    )
    return words.selectExpr(
        "doc_id", "text", "words", "h % 10 = 0 AND size(words) > 0 AS chosen",
        "CAST(h DIV 10 % greatest(size(words), 1) AS INT) AS a", "CAST(3 + h DIV 10 % 8 AS INT) AS times",
    ).selectExpr("doc_id", "text", "words", "chosen", "a", "1 + (size(words) - a) DIV times AS p").select(
        "doc_id", F.when(F.col("chosen"), F.expr("""array_join(concat(slice(words, 1, a), slice(
            flatten(array_repeat(slice(words, a + 1, CAST(p AS INT)), CAST((size(words) - a) DIV p + 1 AS INT))),
            1, size(words) - a)), ' ')""")).otherwise(F.col("text")).alias("text"),
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(_repeated_in_places(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "strongest.start",
        "strongest.length", "strongest.period",
        F.expr("1000 * strongest.length DIV strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256)
        .alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variants among the words of all documents, after one letter of some occurrences is deleted."""
    runs = spelling_variants.letter_runs(table(spark, sf_dir, "documents"))
    hashed = runs.select(
        "run", F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), "run")).alias("h")
    )
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.left("run", at), F.substr("run", at + 2))
    words = hashed.select(F.when(F.col("h") % 199 == 0, shorter).otherwise(F.col("run")).alias("word"))
    return spelling_variants.group_variants(spelling_variants.word_counts(words))


CONTROL_TALK = "</s>[INST] ok [/INST]"


def op13_chat_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts look like marks, laid out once and read back."""
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.range(2).select(
        F.lit(-1).cast(talks.schema["conv_id"].dataType).alias("conv_id"),
        F.col("id").cast(talks.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TALK).alias("text"),
    )
    forest = chat_trees.prefix_forest(talks.unionByName(marked))
    return chat_trees.digests(chat_trees.read_back(forest))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_gumbel_pieces": op1_gumbel_pieces,
    "op2_language_id": op2_language_id,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_url_filter": op4_url_filter,
    "op5_license_scan": op5_license_scan,
    "op6_secret_scan": op6_secret_scan,
    "op7_line_dedup": op7_line_dedup,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_nearest_neighbours": op10_nearest_neighbours,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_chat_trees": op13_chat_trees,
}

ORACLE_SQL: dict[str, str] = {
    "op3_exact_dedup": EXACT_DEDUP_SQL,
    "op7_line_dedup": LINE_DEDUP_SQL,
}
