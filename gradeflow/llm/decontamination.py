"""Benchmark passages in documents, found through a positional inverted index.

The index stores where each word of the documents stands: postings (term, row, pos), sorted by
term in every file, so that a search reads the terms that it asks for.  A test passage is
searched from its rarest words: the places of each, less its offset in the passage, are where
the passage could begin; what all lists agree on is a candidate, and is compared with the
document's words in full.  Proximity matches ask for all words of a passage, in any order,
among so many consecutive words of a document.

Only DataFrame functions are used.  No join has a hint: every joined table is a written one, so
Spark knows its size, and broadcasts it only below its own threshold.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gradeflow.llm.common import landed

#: A word is a run of digits, lower-case letters and whatever is beyond ASCII; these stand between words.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of a window.
WIDTH = 10
#: Lists that are intersected before a candidate is compared in full.
LISTS = 2
#: Most rows whose numbers are sent to every task, 8 bytes each.
SENT = 1 << 21
#: Consecutive words of a document that must hold all words of a passage for a proximity match.
NEAR = 20


def plain(text: str) -> Column:
    """The words of a text column, A-Z lower-cased, with one space between them; empty for null."""
    lower = F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), UPPER, LOWER)
    return F.trim(F.regexp_replace(lower, BETWEEN, " "))


def words(plain_text: Column) -> Column:
    return F.filter(F.split(plain_text, " "), lambda w: w != "")


@dataclass(frozen=True)
class Index:
    """``tokens`` (row, doc_id, n_words, plain): the documents; ``postings`` (term, row, pos)."""

    tokens: DataFrame
    postings: DataFrame


def index(docs: DataFrame, terms: DataFrame | None = None) -> Index:
    """Postings of all words of ``docs``, or of those in ``terms`` (term) alone.

    ``row`` numbers the rows of ``docs``, so that repeated and null ids stay apart.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", plain("text").alias("plain"))
    spaces = F.length("plain") - F.length(F.replace(F.col("plain"), F.lit(" ")))
    n_words = F.when(F.col("plain") == "", 0).otherwise(spaces + 1).cast("long")
    tokens = landed(rows.select("row", "doc_id", n_words.alias("n_words"), "plain"))
    # Not words(): a text without words is left out beforehand.
    postings = tokens.filter("n_words > 0").select("row", F.posexplode(F.split("plain", " ")).alias("pos", "term"))
    if terms is not None:
        postings = postings.join(terms, "term", "left_semi")
    return Index(tokens, landed(postings.select("term", "row", "pos").sortWithinPartitions("term")))


def passages(items: DataFrame, width: int | None = WIDTH) -> tuple[DataFrame, DataFrame]:
    """The different passages (passage, words) of the items, and which items hold them (passage, item).

    Passages are the windows of ``width`` consecutive words, and an item of fewer is one;
    with ``width`` null an item is one passage.  Items without words have none.  ``item`` is the
    id as text, empty if null; rows of one id are one item.
    """
    named = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words(plain("text")).alias("all"))
    named = named.filter("size(all) > 0").distinct()
    if width is None:
        cut = named.select("item", F.col("all").alias("words"))
    else:
        starts = F.explode(F.sequence(F.lit(1), F.greatest(F.size("all") - width + 1, F.lit(1)))).alias("start")
        cut = named.select("item", "all", starts).select("item", F.slice("all", F.col("start"), width).alias("words"))
    cut = landed(cut.distinct())
    different = landed(cut.select("words").distinct().select(F.monotonically_increasing_id().alias("passage"), "words"))
    return different, landed(cut.join(different, "words").select("passage", "item"))


def rarest(postings: DataFrame, found: DataFrame, lists: int) -> DataFrame:
    """term, passage, offset, lists: the rarest words of each passage whose words all occur.

    ``lists`` is how many there are of a passage; fewer than asked for if it is shorter.
    """
    known = landed(postings.groupBy("term").agg(F.count("*").alias("n")))
    each = found.select("passage", F.size("words").alias("length"), F.posexplode("words").alias("offset", "term"))
    each = each.join(known, "term")
    of_passage = W.partitionBy("passage")
    ranked = each.withColumns(
        {
            "held": F.count("*").over(of_passage),
            "rank": F.row_number().over(of_passage.orderBy("n", "offset")),
        }
    )
    ranked = ranked.filter((F.col("held") == F.col("length")) & (F.col("rank") <= lists))
    return landed(ranked.select("term", "passage", "offset", F.least("length", F.lit(lists)).alias("lists")))


def with_texts(held: Index, found: DataFrame) -> DataFrame:
    """``found`` (row, ...), a written table, with doc_id and the ``words`` of its rows.

    Where its rows are few enough to be sent to every task, only their texts are shuffled.
    """
    texts = held.tokens.select("row", "doc_id", "plain")
    if found.count() <= SENT:
        texts = texts.join(F.broadcast(found.select("row").distinct()), "row", "left_semi")
    return texts.join(found, "row").withColumn("words", words(F.col("plain"))).drop("plain")


def phrase_matches(held: Index, found: DataFrame, lists: int = LISTS) -> DataFrame:
    """row, doc_id and ``spans`` of every document with a match: passage, start, stop of each exact match.

    ``start`` counts words from 0; ``stop`` is the first word behind the match.
    """
    asked = rarest(held.postings, found, lists)
    places = held.postings.join(asked, "term").select(
        "row", "passage", "lists", (F.col("pos") - F.col("offset")).alias("start")
    )
    # A word stands at one offset of a passage once, so lists that agree are counted by rows.
    agreed = places.filter("start >= 0").groupBy("row", "passage", "start", "lists").agg(F.count("*").alias("n"))
    candidates = agreed.filter("n = lists").join(found.withColumnRenamed("words", "asked"), "passage")
    # A row's candidates are no more than its own words times the passages that hold one.
    of_row = candidates.groupBy("row").agg(F.collect_list(F.struct("passage", "start", "asked")).alias("candidates"))
    same = F.filter("candidates", lambda c: F.slice("words", c["start"] + 1, F.size(c["asked"])) == c["asked"])
    spans = F.transform(
        same,
        lambda c: F.struct(
            c["passage"].alias("passage"),
            c["start"].alias("start"),
            (c["start"] + F.size(c["asked"])).alias("stop"),
        ),
    )
    matched = with_texts(held, landed(of_row)).select("row", "doc_id", spans.alias("spans"))
    return landed(matched.filter(F.size("spans") > 0))


def proximity_matches(held: Index, found: DataFrame, near: int = NEAR, lists: int = LISTS) -> DataFrame:
    """row, doc_id, passage, start: documents with all words of a passage among ``near`` consecutive ones.

    ``start`` is the first place from which ``near`` words (or what is left of the
    document) hold them, in any order and whatever stands between.
    """
    sets = found.select("passage", F.array_distinct("words").alias("words")).filter(F.size("words") <= near)
    asked = rarest(held.postings, sets, lists)
    # Stretches of 2 * near words that overlap by half: each run of ``near`` words lies in one.
    places = held.postings.join(asked, "term").withColumn("last", F.floor(F.col("pos") / near))
    stretch = F.explode(F.array("last", F.col("last") - 1)).alias("stretch")
    places = places.select("row", "passage", "lists", "term", stretch).filter("stretch >= 0")
    both = places.groupBy("row", "passage", "stretch", "lists").agg(F.count_distinct("term").alias("n"))
    candidates = landed(both.filter("n = lists").select("row", "passage", "stretch"))
    begin = (F.col("stretch") * near).cast("int")
    stretches = with_texts(held, candidates).withColumn("all", F.slice("words", begin + 1, 2 * near)).drop("words")
    cut = stretches.join(sets, "passage").withColumn("begin", begin)
    starts = F.filter(
        F.sequence(F.lit(0), F.greatest(F.size("all") - near, F.lit(0))),
        lambda s: F.size(F.array_except("words", F.slice("all", s + 1, near))) == 0,
    )
    hits = cut.select("row", "doc_id", "passage", "begin", F.element_at(F.concat(starts, F.array(F.lit(-1))), 1).alias("first"))
    hits = hits.filter("first >= 0")
    return hits.groupBy("row", "doc_id", "passage").agg(F.min(F.col("begin") + F.col("first")).alias("start"))


def covered(spans: Column) -> Column:
    """Words inside any of the spans."""
    ranges = F.array_sort(
        F.transform(spans, lambda s: F.struct(s["start"].cast("long").alias("start"), s["stop"].cast("long").alias("stop")))
    )
    none = F.struct(F.lit(0).cast("long").alias("words"), F.lit(0).cast("long").alias("end"))
    folded = F.aggregate(
        ranges,
        none,
        lambda seen, s: F.struct(
            (seen["words"] + F.greatest(F.lit(0).cast("long"), s["stop"] - F.greatest(s["start"], seen["end"]))).alias("words"),
            F.greatest(seen["end"], s["stop"]).alias("end"),
        ),
    )
    return folded["words"]


def contamination(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row of ``docs``.

    A word is hit inside any match of a window of ``width`` words of an item.  Texts that are
    null, empty or without words have no hits, and items without words none to give; an
    item of fewer words is a window as a whole.  Repeated rows give a row each; a null id of
    an item is an empty one; an empty table of documents gives no rows, and one of items no
    hits.  Other columns are ignored.
    """
    found, holders = passages(items.select("item_id", "text"), width)
    terms = landed(found.select(F.explode("words").alias("term")).distinct())
    held = index(docs.select("doc_id", "text"), terms)
    matched = phrase_matches(held, found)
    hit = matched.select("row", F.explode(F.array_distinct(F.transform("spans", lambda s: s["passage"]))).alias("passage"))
    named = hit.join(holders, "passage").groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    told = matched.select("row", covered(F.col("spans")).alias("n_hit")).join(named, "row").select(
        F.col("row").alias("_row"),
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
    )
    joined = held.tokens.select("row", "doc_id", "n_words").join(landed(told), F.col("row") == F.col("_row"), "left")
    none = F.lit(0).cast("long")
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", none).alias("n_hit"),
        F.coalesce("n_items", none).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


_WORDS_SQL = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

CONTAMINATION_SQL = rf"""
with docs as (select row_number() over () as r, doc_id, {_WORDS_SQL} as w from documents),
items as (select coalesce(cast(item_id as varchar), '') as item, {_WORDS_SQL} as w from benchmark),
windows as (
  select distinct item, w[s:s + 9] as v from (
    select item, w, unnest(range(1, greatest(len(w) - 8, 2))) as s from items where len(w) > 0)),
lengths as (select distinct len(v) as n from windows),
grams as (
  select r, s, n, w[s:s + n - 1] as v from (
    select r, w, n, unnest(range(1, len(w) - n + 2)) as s from docs, lengths where len(w) >= n)),
found as (select r, s, n, item from grams join windows using (v)),
hits as (select r, count(distinct p) as n_hit from (select r, unnest(range(s, s + n)) as p from found) group by r),
named as (
  select r, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct r, item from found) group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
  cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from docs left join hits using (r) left join named using (r)
"""
