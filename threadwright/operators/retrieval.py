"""TF-IDF retrieval of similar past requests as joins over term postings.

The index stores the term counts of each *distinct* text once (copies only count) in blocks of texts, with the
document frequencies of each block's terms, and for every (text, intent) the first few documents. A search
weights the blocks in one pass however many queries there are, keeps the postings of the queries' terms and joins
them by term; which side travels is left to size-based planning, and frequent terms to adaptive skew splitting.

A search is pruned without changing its result: a few best postings per term give each query a
lower bound for its k-th score; frequent terms that cannot lift a text over that bound by
themselves then yield no candidates, so common words do not pair every query with every text.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import ngrams, word_tokens
from ..functions.vocab import ENGLISH_STOP_WORDS, INTENT_BOOST, TOP_K
from ..sources.staging import stage, stage_bucketed
from .postings import PART_BYTES, count_blocks, document_frequencies, weighted

CHAMPIONS = 32
FEW_TERMS = 100_000  # query terms that each task is told
ROUNDING = 2e-9  # scores are ranked on nine decimals
ANY_INTENT = ""


def english_stop_words() -> list[str]:
    """Spark's English list; pass another list where parity needs it."""
    return list(ENGLISH_STOP_WORDS)


@dataclass(frozen=True)
class TermStatistics:
    """Vocabulary (term, df, idf) of terms with ``df >= min_df``."""

    vocabulary: DataFrame


@dataclass(frozen=True)
class Index:
    statistics: TermStatistics
    blocks: DataFrame  # counts of distinct texts (bucketed by block)
    frequencies: DataFrame  # block, total: df of the block's terms, bucketed alike
    n_docs: int
    min_df: int
    documents: DataFrame  # text_id, doc_id, intent: first documents per (text, intent), bucketed alike
    fallback: DataFrame  # pad_key, doc_id, intent: first documents per intent and overall
    stop_words: tuple[str, ...]
    max_n: int
    depth: int


def distinct_texts(base: DataFrame) -> DataFrame:
    """(text_id, copies, digest, text) of each distinct text, dealt by text_id; the smallest id stands for all copies.

    Texts are told apart by digests and travel once; a row that repeats an id with its text comes again.
    """
    firsts = base.groupBy(F.md5("text").alias("digest")).agg(F.min("doc_id").alias("text_id"), F.count(F.lit(1)).alias("copies"))
    rows = base.select("doc_id", "text", F.md5("text").alias("of_digest"))
    found = rows.join(firsts.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("text_id"))).filter("digest = of_digest")
    return found.select("text_id", "copies", "digest", "text")


def term_counts(texts: DataFrame, stop_words: Sequence[str], max_n: int = 2) -> DataFrame:
    """(text_id, term, tf) of a search's texts."""
    tokens = texts.select("text_id", word_tokens(F.col("text"), stop_words).alias("tokens"))
    exploded = tokens.select("text_id", F.explode(ngrams(F.col("tokens"), max_n)).alias("term"))
    return exploded.groupBy("text_id", "term").agg(F.count(F.lit(1)).alias("tf"))


def inverse_document_frequency(vocabulary: DataFrame, n_docs: int) -> DataFrame:
    """Smoothed idf ``ln((1 + n) / (1 + df)) + 1``; df counts documents, copies included."""
    return vocabulary.withColumn("idf", F.log((F.lit(1.0) + n_docs) / (F.col("df") + 1.0)) + 1.0)


def normalised(counts: DataFrame, statistics: TermStatistics, key: str) -> DataFrame:
    """(key, term, df, w): tf * idf with unit length per key; unknown terms are dropped."""
    idf = statistics.vocabulary.select("term", "df", "idf")
    weighted = counts.select(key, "term", "tf").join(idf, "term").select(key, "term", "df", (F.col("tf") * F.col("idf")).alias("x"))
    # the postings of one key come from one text, so this window is as small as a text
    norm = F.sqrt(F.sum(F.col("x") * F.col("x")).over(Window.partitionBy(key)))
    return weighted.select(key, "term", "df", (F.col("x") / norm).alias("w"))


def _size(docs: DataFrame, text_col: str) -> tuple[int, int]:
    """Rows, and bytes of text."""
    return tuple(docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first())


def _partitions(df: DataFrame, asked: int | None) -> int:
    return asked or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def tfidf_postings(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    stop_words: Sequence[str] | None = None,
    max_n: int = 2,
    min_df: int = 2,
    buckets: int | None = None,
) -> DataFrame:
    """(id, term, w) of every document, copies included.

    Only the texts are shuffled (once, by id) and the dictionaries of their blocks; postings are counted,
    stored and weighted in place.
    """
    stops = tuple(english_stop_words() if stop_words is None else stop_words)
    parts = _partitions(docs, buckets)
    texts = docs.select(
        F.col(id_col).alias("text_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.lit(1).alias("copies")
    ).repartition(parts, "text_id")
    n_docs, n_bytes = _size(docs, text_col)
    blocks = count_blocks(texts, stops, max_n, parts, max(1, n_bytes // PART_BYTES))
    frequencies, _ = document_frequencies(blocks, min_df, parts)
    return weighted(blocks, frequencies, n_docs, min_df).withColumnRenamed("text_id", id_col)


def first_documents(base: DataFrame, keep: int) -> DataFrame:
    """(text_id, doc_id, intent): the first ``keep`` documents of each (text, intent).

    Every copy of a text scores the same, so these decide any top list. Texts travel as digests.
    """
    hashed = base.select("doc_id", "intent", F.md5("text").alias("digest"))
    order = Window.partitionBy("digest", "intent").orderBy("doc_id")
    first = hashed.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= keep)
    grouped = first.groupBy("digest").agg(
        F.min("doc_id").alias("text_id"), F.collect_list(F.struct("doc_id", "intent")).alias("d")
    )
    return grouped.select("text_id", F.explode("d").alias("d")).select("text_id", "d.doc_id", "d.intent")


def build_index(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    intent_col: str | None = None,
    stop_words: Sequence[str] | None = None,
    max_n: int = 2,
    min_df: int = 2,
    depth: int = TOP_K,
    buckets: int | None = None,
) -> Index:
    """Build a reusable index that answers top-k searches for any ``k <= depth``."""
    stops = tuple(english_stop_words() if stop_words is None else stop_words)
    parts = _partitions(docs, buckets)
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        (F.lit(None).cast("string") if intent_col is None else F.col(intent_col)).alias("intent"),
    )
    n_docs, n_bytes = _size(base, "text")
    blocks = count_blocks(distinct_texts(base), stops, max_n, parts, max(1, n_bytes // PART_BYTES))
    frequencies, vocabulary = document_frequencies(blocks, min_df, parts)
    statistics = TermStatistics(inverse_document_frequency(vocabulary, n_docs))

    keep = depth + 1  # one more, because a query may leave its own document out
    documents = first_documents(base, keep).repartition(parts, "text_id")
    documents = stage_bucketed(documents, "documents", "text_id", parts)

    ids = base.select("doc_id", "intent")
    per_intent = Window.partitionBy("intent").orderBy("doc_id")
    by_intent = ids.filter("intent IS NOT NULL").withColumn("rn", F.row_number().over(per_intent))
    by_intent = by_intent.filter(F.col("rn") <= keep).select(F.col("intent").alias("pad_key"), "doc_id", "intent")
    overall = ids.orderBy("doc_id").limit(keep).select(F.lit(ANY_INTENT).alias("pad_key"), "doc_id", "intent")
    fallback = stage(by_intent.unionByName(overall), "fallback")
    return Index(statistics, blocks, frequencies, n_docs, min_df, documents, fallback, stops, max_n, depth)


def query_postings(queries: DataFrame, index: Index) -> DataFrame:
    """(q, term, df, w) of distinct query texts, weighted with the index vocabulary."""
    parts = _partitions(queries, None)
    texts = queries.select(F.col("q").alias("text_id"), "text").repartition(parts, "text_id")
    counts = stage(term_counts(texts, index.stop_words, index.max_n).withColumnRenamed("text_id", "q"), "query_terms")
    return normalised(counts, index.statistics, "q")


def heaviest_postings(postings: DataFrame, per_term: int = CHAMPIONS) -> DataFrame:
    """(text_id, term, w): at most ``per_term`` postings of each term, limited before the shuffle."""
    by_weight = Window.partitionBy("term").orderBy(F.desc("w"), "text_id")
    return postings.withColumn("rn", F.row_number().over(by_weight)).filter(F.col("rn") <= per_term).drop("rn")


def asked_postings(weights: DataFrame, index: Index) -> DataFrame:
    """(text_id, term, w): the index's postings of the terms that any query has.

    A few terms are looked for where the blocks are weighted; many meet the postings in a join.
    """
    terms = weights.select("term").distinct()
    some = [row["term"] for row in terms.limit(FEW_TERMS + 1).collect()]
    few = len(some) <= FEW_TERMS
    postings = weighted(index.blocks, index.frequencies, index.n_docs, index.min_df, some if few else None)
    return postings if few else postings.join(terms, "term", "left_semi")


def search_plan(weights: DataFrame, index: Index, margin: float, keep: int, postings: DataFrame | None = None) -> DataFrame:
    """(q, term, wq, essential, min_w, theta, rest): which postings can still matter per query.

    The ``keep``-th best sum over the champion lists is at most the ``keep``-th best score;
    ``theta`` is that bound less ``margin``. The most frequent terms whose largest contributions add
    up to ``rest`` < ``theta`` cannot lift a text to the bound by themselves and are not essential. A
    posting lighter than ``min_w`` belongs to a text that stays below the bound even if all its
    other terms contribute their most.
    """
    postings = asked_postings(weights, index) if postings is None else postings
    champions = heaviest_postings(postings)
    seeds = champions.join(weights.select("q", "term", "df", F.col("w").alias("wq")), "term")
    partial = seeds.groupBy("q", "text_id").agg(F.sum(F.col("w") * F.col("wq")).alias("s"))
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("s"), "text_id"))
    bound = partial.withColumn("rn", place).filter(F.col("rn") <= keep).groupBy("q").agg(
        F.min(F.when(F.col("rn") == keep, F.col("s"))).alias("bound")
    )
    terms = seeds.groupBy("q", "term", "wq", "df").agg((F.max("w") * F.col("wq")).alias("most"))
    # a query's terms come from one text, so these windows are small
    of_query = Window.partitionBy("q")
    frequent_first = of_query.orderBy(F.desc("df"), "term").rowsBetween(Window.unboundedPreceding, 0)
    theta = F.coalesce("bound", F.lit(0.0)) - margin - ROUNDING
    return (
        terms.join(bound, "q", "left")
        .withColumn("theta", theta)
        .withColumn("essential", F.sum("most").over(frequent_first) >= F.col("theta"))
        .withColumn("others", F.sum("most").over(of_query) - F.col("most"))
        .withColumn("rest", F.sum(F.when(F.col("essential"), 0.0).otherwise(F.col("most"))).over(of_query))
        .withColumn("min_w", (F.col("theta") - F.col("others")) / F.col("wq"))
        .select("q", "term", "wq", "essential", "min_w", "theta", "rest")
    )


def _scores(weights: DataFrame, index: Index, margin: float, keep: int) -> DataFrame:
    """(q, text_id, s) of every text that can be among a query's ``keep`` best.

    Essential terms are summed in one pass; what cannot reach the bound is dropped there, and the
    frequent terms are looked up for the survivors only.
    """
    postings = stage(asked_postings(weights, index), "asked_postings")  # the one pass over the index
    plan = stage(search_plan(weights, index, margin, keep, postings), "search_plan")
    essential = plan.filter("essential").select("q", "term", "wq", "min_w")
    limits = plan.select("q", "theta", "rest").distinct()
    first = postings.join(essential, "term").filter(F.col("w") >= F.col("min_w"))
    first = first.groupBy("q", "text_id").agg(F.sum(F.col("w") * F.col("wq")).alias("s"))
    survivors = stage(first.join(limits, "q").filter(F.col("s") + F.col("rest") >= F.col("theta")), "survivors")
    frequent = plan.filter("NOT essential").select("q", "term", "wq")
    asked = survivors.filter("rest > 0").select("q", "text_id").join(frequent, "q")
    known = postings.join(frequent.select("term").distinct(), "term", "left_semi")
    more = asked.join(known, ["text_id", "term"])
    parts = survivors.select("q", "text_id", "s").unionByName(
        more.select("q", "text_id", (F.col("w") * F.col("wq")).alias("s"))
    )
    return parts.groupBy("q", "text_id").agg(F.sum("s").alias("s"))


def _search(weights: DataFrame, units: DataFrame, index: Index, boost: float, keep: int) -> DataFrame:
    """Best ``keep`` (unit, document) pairs."""
    scores = _scores(weights, index, boost, keep).select("q", "text_id", F.round("s", 9).alias("similarity"))
    found = scores.join(index.documents, "text_id").join(units.select("unit", "q", "query_intent"), "q")
    return _best(found, boost, keep)


def _best(found: DataFrame, boost: float, keep: int) -> DataFrame:
    same = F.coalesce(F.col("intent") == F.col("query_intent"), F.lit(False))
    adjusted = F.round(F.col("similarity") + F.when(same, F.lit(boost)).otherwise(0.0), 9)
    order = Window.partitionBy("unit").orderBy(F.desc("adjusted"), "doc_id")
    columns = ["unit", "query_intent", "doc_id", "intent", "similarity", "adjusted"]
    ranked = found.withColumn("adjusted", adjusted).select(*columns).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= keep)


def retrieve(
    queries: DataFrame,
    index: Index,
    k: int = TOP_K,
    query_id: str = "query_id",
    text_col: str = "text",
    intent_col: str | None = None,
    own_doc_col: str | None = None,
    boost: float = INTENT_BOOST,
    pad: bool = True,
) -> DataFrame:
    """(query_id, rank, doc_id, intent, similarity): exactly ``k`` best documents per query.

    Documents with the query's intent gain ``boost`` in the ranking only. ``pad`` also ranks
    documents without any common term (similarity 0) so that ``k`` rows come back. ``own_doc_col``
    names the document a query itself came from; it is then left out of that query's results.

    Equal queries are searched once, and all distinct ones together.
    """
    if k > index.depth:
        raise ValueError(f"index was built for k <= {index.depth}")
    keep = k + 1 if own_doc_col else k
    boost = boost if intent_col else 0.0
    asked = queries.select(
        F.col(query_id).alias("query_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        (F.lit(None).cast("string") if intent_col is None else F.col(intent_col)).alias("query_intent"),
        (F.lit(None).cast("bigint") if own_doc_col is None else F.col(own_doc_col)).alias("own_id"),
    ).withColumn("q", F.md5("text"))
    asked = asked.withColumn("unit", F.concat_ws("|", "q", F.coalesce("query_intent", F.lit(ANY_INTENT))))
    units = stage(asked.select("unit", "q", "query_intent", "text").distinct(), "query_units")
    weights = stage(query_postings(units.select("q", "text").distinct(), index), "query_postings")
    best = _search(weights, units, index, boost, keep)
    if pad:
        columns = ["unit", "query_intent", "doc_id", "intent", "similarity"]
        zero = F.lit(0.0).alias("similarity")
        # the overall list has depth + 1 rows; the per-intent lists are joined by their size
        overall = index.fallback.filter(F.col("pad_key") == ANY_INTENT)
        listed = overall.agg(F.collect_list(F.struct("doc_id", "intent")).alias("d")).scalar()
        everyone = units.select("unit", "query_intent", F.explode(listed).alias("d"))
        pads = everyone.select("unit", "query_intent", "d.doc_id", "d.intent", zero)
        alike = units.filter("query_intent IS NOT NULL").withColumn("pad_key", F.col("query_intent"))
        same = index.fallback.filter(F.col("pad_key") != ANY_INTENT).select("pad_key", "doc_id", "intent")
        pads = pads.unionByName(alike.join(same, "pad_key").select("unit", "query_intent", "doc_id", "intent", zero))
        merged = best.select(*columns).unionByName(pads)
        merged = merged.groupBy("unit", "query_intent", "doc_id", "intent").agg(F.max("similarity").alias("similarity"))
        best = _best(merged, boost, keep)

    # a copy-heavy query fans out only here, to k rows per asking row
    listed = best.groupBy("unit").agg(
        F.array_sort(F.collect_list(F.struct("rank", "doc_id", "intent", "similarity"))).alias("hits")
    )
    others = F.filter("hits", lambda h: ~F.coalesce(h["doc_id"] == F.col("own_id"), F.lit(False)))
    return (
        asked.select("query_id", "unit", "own_id")
        .join(listed, "unit")
        .select("query_id", F.posexplode(F.slice(others, 1, k)).alias("pos", "h"))
        .select(
            "query_id",
            (F.col("pos") + 1).cast("long").alias("rank"),
            "h.doc_id",
            "h.intent",
            "h.similarity",
        )
    )


def evidence(hits: DataFrame, corpus: DataFrame, doc_col: str = "tweet_id") -> DataFrame:
    """(query_id, evidence): ranked array of past cases; an array holds at most k of them."""
    payload = corpus.select(
        F.col(doc_col).alias("doc_id"),
        "thread_root_tweet_id",
        "customer_text",
        "support_text",
        "response_type",
    )
    item = F.struct(
        F.col("rank"),
        F.col("similarity").alias("similarity_score"),
        F.col("intent"),
        F.col("response_type"),
        F.col("customer_text").alias("historical_customer_text"),
        F.col("support_text").alias("historical_support_text"),
        F.col("doc_id").alias("source_tweet_id"),
        F.col("thread_root_tweet_id"),
    )
    return hits.join(payload, "doc_id").groupBy("query_id").agg(F.array_sort(F.collect_list(item)).alias("evidence"))
