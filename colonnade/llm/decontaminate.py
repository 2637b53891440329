"""Benchmark decontamination with a distributed positional inverted index.

The index is a written table of postings (term, doc, mark, pos) of the terms that benchmark items hold,
sorted by term inside each file, so that a lookup of terms reads few row groups. A phrase (a window of
``WINDOW`` consecutive item words; shorter items are one window) is answered from its rarest terms: the
postings of the rarest give candidate starts ``pos - offset``, which are intersected with the
offset-adjusted postings of the next rarest, and at last of all others. Proximity matches ask for the
rarest terms of a window within ``SLOP`` words in any order. DataFrame functions only; nothing is collected.

Defined cases: null or empty texts and items have no words and match nothing; repeated items with other
ids are all reported, repeated documents each get their own row; documents are told apart by id and a
64-bit fingerprint of the text, so null and repeated ids work; an item id that is null is not listed;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colonnade.llm import common
from colonnade.llm.license_scan import NOT_WORD
from colonnade.session import materialize

WINDOW = 10
ANCHORS = 3  # rarest terms intersected one after the other; the rest follow in one step
SLOP = 15

DOC = ["doc", "mark"]
LENGTH_WORD = "\u0000"  # no word holds this character


def words_of(text):
    """The words of a text as an array, case as it is; empty for none."""
    return F.array_remove(F.split(text, NOT_WORD), "")


def windows_of(items: DataFrame, size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """The distinct windows of all items as (window, len, off, word), and which items hold them (window, item_id)."""
    rows = items.select("item_id", F.transform(words_of(common.text_of(items)), common.lower_word).alias("words")).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - size, F.lit(0)))
    cut = rows.select("item_id", "words", F.explode(starts).alias("start")).select(
        "item_id", F.slice("words", F.col("start") + 1, size).alias("words"))
    cut = materialize(cut.withColumn("window", F.concat_ws(" ", "words")), "windows")
    terms = cut.dropDuplicates(["window"]).select("window", F.size("words").alias("len"), F.posexplode("words").alias("off", "word"))
    numbered = F.xxhash64("window")
    return (materialize(terms.select(numbered.alias("window"), "len", "off", "word"), "window-terms"),
            cut.select(numbered.alias("window"), "item_id").distinct())


def build_index(docs: DataFrame, words: DataFrame) -> DataFrame:
    """The postings of all documents for the given distinct words: term, doc, mark, pos. ``docs`` has doc_id, text. Every
    document row also has one posting of ``LENGTH_WORD``, whose pos is its number of words."""
    rows = docs.select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("mark"), words_of(F.col("text")).alias("words"))
    places = rows.select("doc", "mark", F.posexplode(F.concat("words", F.array(F.lit(LENGTH_WORD)))).alias("pos", "word"))
    places = places.withColumn("word", common.lower_word(F.col("word")))
    terms = words.select("word").union(docs.sparkSession.createDataFrame([(LENGTH_WORD,)], "word string")).select("word", F.xxhash64("word").alias("term"))
    postings = places.join(materialize(terms, "index-terms"), "word").select("term", "doc", "mark", "pos")
    return materialize(postings.sortWithinPartitions("term"), "postings")


def document_lengths(postings: DataFrame) -> DataFrame:
    """(doc, mark, n_words), one row for each document row."""
    return postings.filter(F.col("term") == F.xxhash64(F.lit(LENGTH_WORD))).select("doc", "mark", F.col("pos").cast("long").alias("n_words"))


def ranked_terms(terms: DataFrame, postings: DataFrame) -> DataFrame:
    """(window, len, off, term, rank): each window's terms from the rarest on. Windows with a term that no document
    holds cannot occur and are left out."""
    frequency = postings.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    known = terms.withColumn("term", F.xxhash64("word")).join(frequency, "term")
    by_window = Window.partitionBy("window")
    known = known.withColumn("found", F.count(F.lit(1)).over(by_window)).filter("found = len")
    rank = F.row_number().over(by_window.orderBy("n", "off"))
    return materialize(known.select("window", "len", "off", "term", rank.alias("rank")), "ranked-terms")


def lists_of(postings: DataFrame, terms: DataFrame) -> DataFrame:
    """The postings of a small set of terms."""
    return postings.join(terms.select("term").distinct(), "term", "left_semi")


def phrase_matches(postings: DataFrame, ranked: DataFrame, anchors: int = ANCHORS) -> DataFrame:
    """Every occurrence of every window: window, len, doc, mark, start."""
    first = ranked.filter("rank = 1")
    found = lists_of(postings, first).join(first, "term").select(
        "window", "len", *DOC, (F.col("pos") - F.col("off")).alias("start")).filter("start >= 0")
    for rank in range(2, anchors + 1):
        step = ranked.filter(F.col("rank") == rank)
        wanted = found.join(step.select("window", "off", "term"), "window", "left").withColumn("pos", F.col("start") + F.coalesce("off", F.lit(0)))
        held = lists_of(postings, step).select(F.col("term").alias("p_term"), F.col("doc").alias("p_doc"), F.col("mark").alias("p_mark"), F.col("pos").alias("p_pos"))
        same = ((F.col("term") == F.col("p_term")) & F.col("doc").eqNullSafe(F.col("p_doc")) & (F.col("mark") == F.col("p_mark")) & (F.col("pos") == F.col("p_pos")))
        hit = wanted.join(held, same, "left_semi").unionByName(wanted.filter("term is null"))
        found = materialize(hit.select("window", "len", *DOC, "start"), "candidates")
    rest = found.join(ranked.filter(F.col("rank") > anchors).select("window", "off", "term"), "window")
    rest = rest.select("window", "len", *DOC, "start", "term", (F.col("start") + F.col("off")).alias("pos"))
    in_docs = postings.join(found.select(F.col("doc").alias("c_doc"), F.col("mark").alias("c_mark")).distinct(),
                            F.col("doc").eqNullSafe(F.col("c_doc")) & (F.col("mark") == F.col("c_mark")), "left_semi").distinct()
    held = in_docs.select(F.col("term").alias("p_term"), F.col("doc").alias("p_doc"), F.col("mark").alias("p_mark"), F.col("pos").alias("p_pos"))
    same = ((F.col("term") == F.col("p_term")) & F.col("doc").eqNullSafe(F.col("p_doc")) & (F.col("mark") == F.col("p_mark")) & (F.col("pos") == F.col("p_pos")))
    full = rest.distinct().join(held, same).groupBy("window", "len", *DOC, "start").count().filter(F.col("count") == F.col("len") - anchors)
    short = found.filter(F.col("len") <= anchors)
    return full.select("window", "len", *DOC, "start").unionByName(short).distinct()


def proximity_matches(postings: DataFrame, ranked: DataFrame, anchors: int = ANCHORS, slop: int = SLOP) -> DataFrame:
    """(window, doc, mark) where the window's rarest terms all stand within ``slop`` words of a place of the rarest,
    in any order. Positions meet by buckets of ``slop`` words, so each join is an equality join."""
    first = ranked.filter("rank = 1")
    found = lists_of(postings, first).join(first, "term").select("window", *DOC, F.col("pos").alias("at"))
    for rank in range(2, anchors + 1):
        step = ranked.filter(F.col("rank") == rank)
        near = F.explode(F.array(*[F.floor(F.col("at") / slop) + d for d in (-1, 0, 1)]))
        wanted = found.join(step.select("window", "term"), "window", "left").withColumn("bucket", near)
        held = lists_of(postings, step).select(F.col("term").alias("p_term"), F.col("doc").alias("p_doc"), F.col("mark").alias("p_mark"),
                                               F.col("pos").alias("p_pos"), F.floor(F.col("pos") / slop).alias("p_bucket"))
        same = ((F.col("term") == F.col("p_term")) & F.col("doc").eqNullSafe(F.col("p_doc")) & (F.col("mark") == F.col("p_mark"))
                & (F.col("bucket") == F.col("p_bucket")) & (F.abs(F.col("at") - F.col("p_pos")) <= slop))
        hit = wanted.join(held, same, "left_semi").unionByName(wanted.filter("term is null"))
        found = hit.select("window", *DOC, "at").distinct()
    return found.select("window", *DOC).distinct()


def hit_words(matches: DataFrame) -> DataFrame:
    """(doc, mark, n_hit): the words inside any match, each counted once."""
    spans = matches.select(*DOC, "start", (F.col("start") + F.col("len")).alias("end")).groupBy(*DOC, "start").agg(F.max("end").alias("end"))
    before = F.max("end").over(Window.partitionBy(*DOC).orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    new = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(before, F.col("start"))))
    return spans.withColumn("new", new).groupBy(*DOC).agg(F.sum("new").alias("n_hit"))


def report(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and n_near_items (items
    with a window whose rarest terms stand close together)."""
    rows = docs.select("doc_id", common.text_of(docs).alias("text"))
    terms, holders = windows_of(items, size)
    postings = build_index(rows, materialize(terms.select("word").distinct(), "terms"))
    ranked = ranked_terms(terms, postings)
    matches = materialize(phrase_matches(postings, ranked), "matches")
    holders = materialize(holders.filter("item_id is not null"), "holders")
    by_item = matches.select("window", *DOC).distinct().join(holders, "window").groupBy(*DOC).agg(
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("ids"))
    near = proximity_matches(postings, ranked).join(holders, "window").groupBy(*DOC).agg(F.countDistinct("item_id").alias("n_near_items"))
    out = document_lengths(postings).withColumnRenamed("doc", "doc_id")
    for part in (hit_words(matches), by_item, near):
        part = part.withColumnsRenamed({"doc": "p_doc", "mark": "p_mark"})
        out = out.join(part, F.col("doc_id").eqNullSafe(F.col("p_doc")) & (F.col("mark") == F.col("p_mark")), "left").drop("p_doc", "p_mark")
    return out.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("ids", ","), F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), F.coalesce("n_near_items", F.lit(0)).cast("long").alias("n_near_items"))


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` without the rows that hold a window of an item; all columns stay."""
    rows = docs.select("doc_id", common.text_of(docs).alias("text"))
    terms, _ = windows_of(items, size)
    postings = build_index(rows, materialize(terms.select("word").distinct(), "terms"))
    matches = phrase_matches(postings, ranked_terms(terms, postings))
    gone = materialize(matches.select(F.col("doc").alias("__doc"), F.col("mark").alias("__mark")).distinct(), "contaminated")
    mark = F.xxhash64(common.text_of(docs))
    return docs.join(gone, docs["doc_id"].eqNullSafe(F.col("__doc")) & (mark == F.col("__mark")), "left_anti")
