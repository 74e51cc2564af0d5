"""Licence statements by ordered signature rules. DataFrame functions only.

A rule is a regular expression with a keyword, a priority and a weight; :data:`RULES` has four
kinds of them for each licence: its tag, a grant that names it, its address, its bare name. A
text is searched by a rule only if it holds the rule's keyword, and at all only if it holds one
of the few stems that every rule needs. Detections overlap: of two where one interval contains
the other, the one of lower priority gives way, and of equal priorities the shorter one.

The texts are read once, and one row per text is written to the shared folder, with the text
only where a stem occurs. Detections are rows of numbers, ordered per text in a window.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventpulse.llm._common import col, lower_ascii, numbered, saved

# Fixed values of the contract: words, and the phrases that give the base labels.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = (
    (("mit", "license"), "mit"),
    (("apache", "license"), "apache"),
    (("general", "public", "license"), "gpl"),
)

# label; its name as a pattern; its tag, or None; its address, or None; a keyword of the name.
# Patterns are for lower-case text. A name without "licen" has its keyword among the stems.
_L = r"\W{1,3}licen[sc]e"
_V = r"(?:,?\W{1,3}(?:version|v)\W{0,2})?\W{0,2}"
LICENCES = (
    ("mit", rf"(?:the\W+)?mit{_L}", "mit", r"opensource\.org/licenses/mit\b", "licen"),
    ("mit-0", rf"mit\W+no\W+attribution{_L}", "mit-0", r"opensource\.org/licenses/mit-0", "licen"),
    ("apache", rf"apache(?:\W+software)?{_L}", None, r"apache\.org/licenses/?(?:\s|$)", "licen"),
    ("apache-1.1", rf"apache(?:\W+software)?{_L}{_V}1\.1", "apache-1.1",
     r"apache\.org/licenses/license-1\.1", "licen"),
    ("apache-2.0", rf"apache(?:\W+software)?{_L}{_V}2(?:\.0)?", "apache-2.0",
     r"apache\.org/licenses/license-2\.0", "licen"),
    ("gpl", rf"(?:gnu\W+)?general\W+public{_L}", None, r"gnu\.org/licenses/gpl\.html", "licen"),
    ("gpl-1.0", rf"general\W+public{_L}{_V}1(?:\.0)?\b", "gpl-1.0",
     r"gnu\.org/licenses/(?:old-licenses/)?gpl-1", "licen"),
    ("gpl-2.0", rf"general\W+public{_L}{_V}2(?:\.0)?\b", "gpl-2.0",
     r"gnu\.org/licenses/(?:old-licenses/)?gpl-2", "licen"),
    ("gpl-3.0", rf"general\W+public{_L}{_V}3(?:\.0)?\b", "gpl-3.0",
     r"gnu\.org/licenses/gpl-3", "licen"),
    ("lgpl", rf"(?:lesser|library)\W+general\W+public{_L}", None,
     r"gnu\.org/licenses/lgpl\.html", "licen"),
    ("lgpl-2.1", rf"lesser\W+general\W+public{_L}{_V}2\.1", "lgpl-2.1",
     r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1", "licen"),
    ("lgpl-3.0", rf"lesser\W+general\W+public{_L}{_V}3(?:\.0)?\b", "lgpl-3.0",
     r"gnu\.org/licenses/lgpl-3", "licen"),
    ("agpl-3.0", rf"affero\W+general\W+public{_L}{_V}3?(?:\.0)?", "agpl-3.0",
     r"gnu\.org/licenses/agpl", "licen"),
    ("gfdl", rf"gnu\W+free\W+documentation{_L}", "gfdl-1.3", r"gnu\.org/licenses/fdl", "licen"),
    ("bsd", rf"bsd(?:\W+style)?{_L}", None, r"opensource\.org/licenses/bsd-license", "licen"),
    ("bsd-2-clause", rf"(?:bsd\W+(?:2|two)\W+clause|simplified\W+bsd|freebsd){_L}", "bsd-2-clause",
     r"opensource\.org/licenses/bsd-2-clause", "licen"),
    ("bsd-3-clause", rf"(?:bsd\W+(?:3|three)\W+clause|(?:new|modified|revised)\W+bsd){_L}",
     "bsd-3-clause", r"opensource\.org/licenses/bsd-3-clause", "licen"),
    ("bsd-4-clause", rf"(?:bsd\W+(?:4|four)\W+clause|original\W+bsd){_L}", "bsd-4-clause",
     r"spdx\.org/licenses/bsd-4-clause", "licen"),
    ("0bsd", rf"(?:zero\W+clause\W+bsd|bsd\W+zero\W+clause|free\W+public){_L}", "0bsd",
     r"opensource\.org/licenses/0bsd", "licen"),
    ("isc", rf"\bisc{_L}", "isc", r"opensource\.org/licenses/isc", "licen"),
    ("zlib", rf"zlib(?:/libpng)?{_L}", "zlib", r"zlib\.net/zlib_license", "licen"),
    ("libpng", rf"\blibpng{_L}", "libpng", r"libpng\.org/pub/png/src/libpng-license", "licen"),
    ("mpl", rf"mozilla\W+public{_L}", None, r"mozilla\.org/mpl/?(?:\s|$)", "licen"),
    ("mpl-1.1", rf"mozilla\W+public{_L}{_V}1\.1", "mpl-1.1", r"mozilla\.org/mpl/1\.1", "licen"),
    ("mpl-2.0", rf"mozilla\W+public{_L}{_V}2\.0", "mpl-2.0", r"mozilla\.org/mpl/2\.0", "licen"),
    ("epl-1.0", rf"eclipse\W+public{_L}{_V}1\.0", "epl-1.0", r"eclipse\.org/legal/epl-v10", "licen"),
    ("epl-2.0", rf"eclipse\W+public{_L}(?:{_V}2\.0)?", "epl-2.0",
     r"eclipse\.org/legal/epl-(?:v20|2\.0)", "licen"),
    ("edl-1.0", rf"eclipse\W+distribution{_L}", "bsd-3-clause-edl",
     r"eclipse\.org/org/documents/edl", "licen"),
    ("cddl-1.0", rf"common\W+development\W+and\W+distribution{_L}", "cddl-1.0",
     r"opensource\.org/licenses/cddl", "licen"),
    ("cpl-1.0", rf"common\W+public{_L}", "cpl-1.0", r"opensource\.org/licenses/cpl", "licen"),
    ("eupl-1.2", rf"european\W+union\W+public{_L}", "eupl-1.2",
     r"joinup\.ec\.europa\.eu/\S{0,60}eupl", "licen"),
    ("artistic-1.0", rf"artistic{_L}{_V}1\.0", "artistic-1.0",
     r"opensource\.org/licenses/artistic-license-1", "licen"),
    ("artistic-2.0", rf"artistic{_L}(?:{_V}2\.0)?", "artistic-2.0",
     r"opensource\.org/licenses/artistic-(?:license-)?2", "licen"),
    ("bsl-1.0", rf"boost\W+software{_L}", "bsl-1.0", r"boost\.org/license_1_0", "licen"),
    ("busl-1.1", rf"business\W+source{_L}", "busl-1.1", r"mariadb\.com/bsl11", "licen"),
    ("sspl-1.0", rf"server\W+side\W+public{_L}", "sspl-1.0",
     r"mongodb\.com/licensing/server-side-public-license", "licen"),
    ("elastic-2.0", rf"elastic{_L}", "elastic-2.0", r"elastic\.co/licensing/elastic-license",
     "licen"),
    ("wtfpl", r"\bwtfpl\b", "wtfpl", r"wtfpl\.net", "wtfpl"),
    ("unlicense", r"\bunlicense\b", "unlicense", r"unlicense\.org", "licen"),
    ("cc0-1.0", r"\bcc0\b(?:\W{0,3}1\.0)?", "cc0-1.0",
     r"creativecommons\.org/publicdomain/zero", "cc0"),
    ("cc-by", r"\bcc[ -]by\b(?![\s-](?:nc|sa|nd))(?:[\s-][1-4]\.0)?", "cc-by-4.0",
     r"creativecommons\.org/licenses/by/", "cc"),
    ("cc-by-sa", r"\bcc[ -]by-sa\b(?:[\s-][1-4]\.0)?", "cc-by-sa-4.0",
     r"creativecommons\.org/licenses/by-sa/", "cc"),
    ("cc-by-nd", r"\bcc[ -]by-nd\b(?:[\s-][1-4]\.0)?", "cc-by-nd-4.0",
     r"creativecommons\.org/licenses/by-nd/", "cc"),
    ("cc-by-nc", r"\bcc[ -]by-nc\b(?!-)(?:[\s-][1-4]\.0)?", "cc-by-nc-4.0",
     r"creativecommons\.org/licenses/by-nc/", "cc"),
    ("cc-by-nc-sa", r"\bcc[ -]by-nc-sa\b(?:[\s-][1-4]\.0)?", "cc-by-nc-sa-4.0",
     r"creativecommons\.org/licenses/by-nc-sa/", "cc"),
    ("cc-by-nc-nd", r"\bcc[ -]by-nc-nd\b(?:[\s-][1-4]\.0)?", "cc-by-nc-nd-4.0",
     r"creativecommons\.org/licenses/by-nc-nd/", "cc"),
    ("creative-commons", rf"creative\W+commons(?:\W+\w+){{0,4}}?{_L}", None,
     r"creativecommons\.org/licenses/?(?:\s|$)", "creative"),
    ("odbl-1.0", rf"open\W+database{_L}", "odbl-1.0", r"opendatacommons\.org/licenses/odbl",
     "licen"),
    ("odc-by-1.0", rf"open\W+data\W+commons\W+attribution{_L}", "odc-by-1.0",
     r"opendatacommons\.org/licenses/by", "licen"),
    ("pddl-1.0", rf"public\W+domain\W+dedication\W+(?:and|&)\W+licen[sc]e", "pddl-1.0",
     r"opendatacommons\.org/licenses/pddl", "licen"),
    ("ofl-1.1", rf"(?:sil\W+)?open\W+font{_L}", "ofl-1.1", r"scripts\.sil\.org/ofl", "licen"),
    ("python-2.0", rf"(?:python\W+software\W+foundation|psf){_L}", "python-2.0",
     r"python\.org/\S{0,40}license", "licen"),
    ("ruby", rf"\bruby(?:'s)?{_L}", "ruby", r"ruby-lang\.org/\S{0,20}license", "licen"),
    ("php-3.01", rf"\bphp{_L}", "php-3.01", r"php\.net/license", "licen"),
    ("postgresql", rf"postgresql{_L}", "postgresql", r"postgresql\.org/about/licen[cs]e", "licen"),
    ("openssl", rf"openssl{_L}", "openssl", r"openssl\.org/source/license", "licen"),
    ("w3c", rf"w3c(?:\W+software)?(?:\W+notice\W+and)?{_L}", "w3c",
     r"w3\.org/consortium/legal/\S{0,40}software", "licen"),
    ("ms-pl", rf"microsoft\W+public{_L}", "ms-pl", r"opensource\.org/licenses/ms-pl", "licen"),
    ("ms-rl", rf"microsoft\W+reciprocal{_L}", "ms-rl", r"opensource\.org/licenses/ms-rl", "licen"),
    ("afl-3.0", rf"academic\W+free{_L}", "afl-3.0", r"opensource\.org/licenses/afl", "licen"),
    ("osl-3.0", rf"open\W+software{_L}", "osl-3.0", r"opensource\.org/licenses/osl", "licen"),
    ("ecl-2.0", rf"educational\W+community{_L}", "ecl-2.0", r"opensource\.org/licenses/ecl",
     "licen"),
    ("ncsa", rf"(?:ncsa|university\W+of\W+illinois)(?:\W+open\W+source)?{_L}", "ncsa",
     r"opensource\.org/licenses/(?:uoi-)?ncsa", "licen"),
    ("upl-1.0", rf"universal\W+permissive{_L}", "upl-1.0", r"opensource\.org/licenses/upl", "licen"),
    ("unicode", rf"unicode{_L}(?:\W+agreement)?", "unicode-3.0", r"unicode\.org/license", "licen"),
    ("vim", rf"\bvim{_L}", "vim", r"vimhelp\.org/uganda", "licen"),
    ("x11", rf"\bx11{_L}", "x11", r"xfree86\.org/\S{0,20}license", "licen"),
    ("beerware", r"beer\W?ware\W+licen[sc]e", "beerware", r"people\.freebsd\.org/~phk", "licen"),
    ("openrail", r"(?:open|bigscience)\W{0,2}rail(?:\W{0,2}[ms])?\W+licen[sc]e", "openrail-m",
     r"bigscience\.huggingface\.co/blog/\S{0,20}rail", "licen"),
)
OTHER = (
    ("all-rights-reserved", "reserved", r"all\s+rights\s+reserved", 3, 0.7),
    # Only A-Z are lower-cased in a text.
    ("all-rights-reserved", "droits", r"tous\s+droits\s+r(?:[éÉ]|e\u0301)serv(?:[éÉ]|e\u0301)s", 3, 0.7),
    ("all-rights-reserved", "derechos", r"todos\s+los\s+derechos\s+reservados", 3, 0.7),
    ("all-rights-reserved", "rechte", r"alle\s+rechte\s+vorbehalten", 3, 0.7),
    ("proprietary", "licen", r"proprietary\s+(?:and\s+confidential\s+)?licen[sc]e", 3, 0.7),
    ("public-domain", "domain", r"(?:in|into|to)\s+the\s+public\s+domain", 3, 0.6),
    ("copyright", "copyright", r"copyright\s+(?:\(c\)|©)?\s*(?:19|20)\d\d", 5, 0.4),
)
@dataclass(frozen=True)
class Rule:
    """``pattern`` is searched where ``keyword`` occurs; a smaller ``priority`` goes first."""

    label: str
    keyword: str
    pattern: str
    priority: int
    weight: float


def _rules() -> tuple[Rule, ...]:
    found = []
    for label, name, tag, address, keyword in LICENCES:
        if tag:
            spdx = rf"spdx-license-identifier:\s*{tag.replace('.', r'\.')}(?:-only|-or-later)?\b"
            found.append(Rule(label, "spdx", spdx, 1, 1.0))
        grant = (
            r"(?:licen[sc]ed|released|distributed|available|published|provided)\s+(?:\w+\s+){0,3}?"
            rf"under\s+(?:the\s+)?(?:terms\s+of\s+the\s+)?(?:gnu\s+)?{name}"
        )
        found.append(Rule(label, keyword, grant, 2, 0.95))
        if address:
            host = address.split("/")[0].replace("\\", "")
            found.append(Rule(label, host, rf"(?:https?://)?(?:www\.)?{address}", 2, 0.9))
        found.append(Rule(label, keyword, name, 4, 0.6))
    return (*found, *(Rule(*other) for other in OTHER))


RULES = _rules()
_COMMON = ("licen", "reserv", "copyright", "domain", "cc by", "cc-by", "cc0", "creative",
           "spdx", "rechte")


def stems(rules: tuple[Rule, ...]) -> tuple[str, ...]:
    """Without any of these, a text meets none of the rules."""
    lone = [
        r.keyword for r in rules
        if r.keyword != "cc" and not any(c in r.keyword for c in _COMMON)  # "cc by" or "cc-by"
    ]
    return tuple(dict.fromkeys([*_COMMON, *lone]))


PRIORITIES = tuple(sorted({rule.priority for rule in RULES}))


def phrase_places(words: Column) -> Column:
    """Places, from 0, where a base phrase begins, with its label."""
    at = F.sequence(F.lit(0), F.size(words) - 1)

    def begins(i: Column) -> Column:
        out = F.lit(None).cast("string")
        for phrase, label in PHRASES:
            here = F.lit(True)
            for k, word in enumerate(phrase):
                here = here & F.coalesce(F.get(words, i + k) == word, F.lit(False))
            out = F.when(here, F.lit(label)).otherwise(out)
        return F.struct(i.cast("bigint").alias("word"), out.alias("label"))

    hits = F.filter(F.transform(at, begins), lambda p: p["label"].isNotNull())
    return F.when(F.size(words) > 0, hits)


def scanned(
    table: DataFrame, id_column: str, text: str, rules: tuple[Rule, ...]
) -> DataFrame:
    """A numbered row per text with its words and base places; the text where a stem occurs."""
    low = table.select(col(id_column).alias("doc_id"), lower_ascii(col(text)).alias("low"))
    some = F.lit(False)
    for stem in stems(rules):
        some = some | F.contains("low", F.lit(stem))
    words = F.regexp_extract_all("low", F.lit(WORD), F.lit(0))
    read = low.select(
        "doc_id", F.regexp_count("low", F.lit(WORD)).cast("bigint").alias("n_words"),
        F.when(some, F.col("low")).alias("low"),
        F.when(F.contains("low", F.lit("license")), words).alias("words"),
    )
    return numbered(read, "row_no").select(
        "row_no", "doc_id", "n_words", "low", phrase_places(F.col("words")).alias("places")
    )


def detections(texts: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every match of every rule: ``row_no, label, priority, weight, start, end``.

    ``texts`` has ``row_no`` and ``low``. A match begins after the pieces and matches before it;
    matches are found by cutting the text at them.
    """
    table = F.array(*[
        F.struct(
            F.lit(i).alias("rule"), F.lit(r.label).alias("label"), F.lit(r.keyword).alias("keyword"),
            F.lit(r.pattern).alias("pattern"), F.lit(r.priority).alias("priority"),
            F.lit(r.weight).alias("weight"),
        )
        for i, r in enumerate(rules)
    ])
    gated = texts.where("low IS NOT NULL").select(
        "row_no", "low",
        F.explode(F.filter(table, lambda r: F.contains(F.col("low"), r["keyword"]))).alias("r"),
    )
    tried = gated.where(F.expr("low RLIKE r.pattern")).select(
        "row_no", "r",
        F.expr("regexp_extract_all(low, r.pattern, 0)").alias("matches"),
        F.expr("split(low, r.pattern, -1)").alias("pieces"),
    )
    lengths = F.zip_with(
        F.expr("slice(pieces, 1, size(matches))"), "matches",
        lambda p, m: F.struct(F.length(p).alias("gap"), F.length(m).alias("len")),
    )
    each = tried.select("row_no", "r", F.posexplode(lengths).alias("nth", "l"))
    each = each.repartition("row_no")
    upto = Window.partitionBy("row_no", "r.rule").orderBy("nth")
    end = F.sum(F.col("l.gap") + F.col("l.len")).over(upto)
    return each.select(
        "row_no", "r.label", "r.priority", "r.weight", F.col("l.len").alias("len"),
        end.cast("bigint").alias("end"),
    ).select("row_no", "label", "priority", "weight", (F.col("end") - F.col("len")).alias("start"),
             "end")


def unsuppressed(found: DataFrame, priorities: tuple[int, ...] = PRIORITIES) -> DataFrame:
    """Detections that no interval of a higher priority, or longer one of their own, contains.

    Equal intervals of equal priority all stay. Ordered by start, then from the longest, whatever
    contains an interval stands before it or is equal to it.
    """
    place = ["row_no", "priority", "start", "end"]
    intervals = found.groupBy(*place).agg(F.collect_set(F.struct("label", "weight")).alias("d"))
    order = (F.col("start"), F.desc("end"))
    own = Window.partitionBy("row_no", "priority").orderBy(*order)
    longer = F.max("end").over(own.rowsBetween(Window.unboundedPreceding, -1))
    every = Window.partitionBy("row_no").orderBy(*order)
    upto = every.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    higher = F.lit(None).cast("bigint")
    for p in priorities:
        above = F.max(F.when(F.col("priority") < p, F.col("end"))).over(upto)
        higher = F.when(F.col("priority") == p, above).otherwise(higher)
    reach = F.greatest(longer, higher)
    kept = intervals.withColumn("_reach", reach).where("_reach IS NULL OR _reach < `end`")
    return kept.select(*place, F.explode("d").alias("d")).select(
        "row_no", "d.label", "priority", "d.weight", "start", "end"
    )


def license_scan(
    table: DataFrame, *, id_column: str = "doc_id", text: str = "text",
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """One row per row of ``table``: ``doc_id, n_words``, ``places`` of base phrases (word and
    label), and ``found``, its unsuppressed detections (label, priority, weight, start, end).

    A null or empty text has no words and no detections. Ids may be null or repeated, other
    columns are not looked at; an empty table gives no rows.
    """
    rows = saved(scanned(table, id_column, text, rules), "scanned")
    kept = unsuppressed(detections(rows, rules), tuple(sorted({r.priority for r in rules})))
    per_text = kept.groupBy("row_no").agg(
        F.sort_array(F.collect_list(F.struct("start", "end", "label", "priority", "weight")))
        .alias("found")
    )
    return rows.drop("low").join(per_text, "row_no", "left").drop("row_no")
