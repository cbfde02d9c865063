"""Sampling, splitting and set queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadwright.functions import vocab as V
from threadwright.functions.rules import length_bucket, topic_bucket
from threadwright.operators import context, metrics, profile, quality, sampling, threads
from threadwright.plans import reports

from .oracle import compose, glitch, matches, q, reply_class, topic
from .registry import query
from .tables import BRAND, Book

#: The library's defaults, but for the pool that a disjoint sample avoids (1000): it would hold every
#: thread of the small tables.
N, POOL, DISJOINT = 400, 200, 200


def drawn(seed: int, n: int = N, source: str = "qual") -> str:
    return f"SELECT root FROM {source} ORDER BY md5('{seed}:' || root), root LIMIT {n}"


SAMPLES = {
    "qual": f"SELECT * FROM st WHERE brand = '{BRAND}' AND n_customer > 0 AND n_support > 0",
    "pool": drawn(2024, POOL),
    "rest": "SELECT root FROM qual WHERE root NOT IN (SELECT root FROM pool)",
    "chosen": drawn(4242, DISJOINT, "rest"),
    "d1": drawn(42),
    "d2": drawn(123),
    "r1": "SELECT t.* FROM t JOIN d1 USING (root)",
    "r2": "SELECT t.* FROM t JOIN d2 USING (root)",
}


def both(b: Book) -> tuple[DataFrame, DataFrame]:
    return reports.paired_samples(b.threads, BRAND, N)


@query("H1", lambda: compose("SELECT tweet_id, root FROM r1", SAMPLES))
def sample_threads(b: Book) -> DataFrame:
    return sampling.sample_threads(b.rows, b.stats, BRAND, N, 42).select("tweet_id", "root")


@query("H2, G2", lambda: compose("SELECT count(*) AS n_overlap FROM d1 JOIN d2 USING (root)", SAMPLES))
def replication_overlap(b: Book) -> DataFrame:
    return reports.sample_overlap(*both(b))


@query("H3, C5", lambda: compose("SELECT root FROM chosen", SAMPLES))
def disjoint_sample(b: Book) -> DataFrame:
    return sampling.disjoint_sample_roots(b.stats, BRAND, DISJOINT, 4242, POOL, 2024)


@query("Q6", lambda: compose("SELECT count(*) AS n_overlap FROM chosen JOIN pool USING (root)", SAMPLES))
def sample_disjointness_gate(b: Book) -> DataFrame:
    chosen = sampling.disjoint_sample_roots(b.stats, BRAND, DISJOINT, 4242, POOL, 2024)
    return quality.overlap(chosen, sampling.sample_roots(b.stats, BRAND, POOL, 2024), "root")


STRATA = {
    "str": (
        "SELECT tweet_id, CASE WHEN thread_size <= 2 THEN 'short' WHEN thread_size <= 4 THEN 'medium' ELSE 'long' END AS length_bucket, "
        f"{topic('customer_text')} AS topic_bucket FROM sheet"
    )
}


@query(
    "H4, I7, I8",
    lambda: compose(
        "SELECT tweet_id, length_bucket, topic_bucket FROM (SELECT *, count(*) OVER p AS n, "
        "row_number() OVER (PARTITION BY length_bucket, topic_bucket ORDER BY md5('77:' || tweet_id), tweet_id) AS k "
        "FROM str WINDOW p AS (PARTITION BY length_bucket, topic_bucket)) "
        "WHERE k <= least(n, greatest(1, round_even(n * 0.45::DOUBLE, 0)))",
        STRATA,
    ),
)
def stratified_training_sample(b: Book) -> DataFrame:
    rows = context.labeling_rows(b.rows).select(
        "tweet_id",
        length_bucket(F.col("thread_size")).alias("length_bucket"),
        topic_bucket(F.col("customer_text")).alias("topic_bucket"),
    )
    return sampling.stratified_share(rows, ["length_bucket", "topic_bucket"], "tweet_id").select(
        "tweet_id", "length_bucket", "topic_bucket"
    )


@query(
    "H4",
    "SELECT o_orderkey, o_orderpriority FROM (SELECT *, count(*) OVER (PARTITION BY o_orderpriority) AS n, "
    "row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5('77:' || o_orderkey), o_orderkey) AS k FROM orders) "
    "WHERE k <= least(n, greatest(1, round_even(n * 0.45::DOUBLE, 0)))",
)
def stratified_order_sample(b: Book) -> DataFrame:
    orders = b.table("orders").select("o_orderkey", "o_orderpriority")
    return sampling.stratified_share(orders, ["o_orderpriority"], "o_orderkey")


DIMENSIONS = ["predicted_intent", "predicted_response_behavior", "predicted_handling"]
COVERAGE = {
    "tagged": f"SELECT tweet_id, {', '.join(DIMENSIONS)}, md5('8080:' || tweet_id) AS h FROM scored",
    "firsts": " UNION ALL ".join(f"SELECT min(h) AS h FROM tagged GROUP BY {d}" for d in DIMENSIONS),
    "cover": "SELECT h FROM firsts GROUP BY h ORDER BY count(*) DESC, h LIMIT 30",
    "others": f"SELECT *, concat_ws(' | ', {', '.join(DIMENSIONS)}) AS label FROM tagged WHERE h NOT IN (SELECT h FROM cover)",
    "strata": "SELECT label, count(*) AS n, (SELECT 30 - count(*) FROM cover) AS room FROM others GROUP BY label",
    "exact": "SELECT *, n * room / sum(n) OVER () AS share FROM strata",
    "quota": (
        "SELECT label, floor(share) + CASE WHEN row_number() OVER (ORDER BY round(share - floor(share), 9) DESC, label) "
        "<= room - sum(floor(share)) OVER () THEN 1 ELSE 0 END AS take FROM exact"
    ),
    "ranked": "SELECT *, row_number() OVER (PARTITION BY label ORDER BY h, tweet_id) AS k FROM others JOIN quota USING (label)",
}


@query(
    "H6, A8",
    lambda: compose(
        f"SELECT tweet_id, {', '.join(DIMENSIONS)} FROM tagged WHERE h IN (SELECT h FROM cover) "
        f"UNION ALL SELECT tweet_id, {', '.join(DIMENSIONS)} FROM ranked WHERE k <= take",
        COVERAGE,
    ),
)
def coverage_sample(b: Book) -> DataFrame:
    return sampling.coverage_sample(b.scored, DIMENSIONS, "tweet_id", 30).select("tweet_id", *DIMENSIONS)


def split_ctes(source: str) -> dict[str, str]:
    """Class totals by largest remainder, twice, then positions in hash order."""

    def share(n: str, total: str, frm: str, out: str) -> str:
        return (
            f"SELECT *, fl + CASE WHEN row_number() OVER (ORDER BY round(ex - fl, 9) DESC, label) <= {total} - sum(fl) OVER () THEN 1 ELSE 0 END AS {out} "
            f"FROM (SELECT *, CAST(floor(ex) AS BIGINT) AS fl FROM (SELECT *, {n}::DOUBLE * {total} / sum({n}) OVER () AS ex FROM {frm}))"
        )

    return {
        "lab": source,
        "c1": (
            "SELECT label, n, total - CAST(ceil(total * 0.30::DOUBLE) AS BIGINT) AS want, CAST(ceil(total * 0.30::DOUBLE) AS BIGINT) - "
            "CAST(ceil(ceil(total * 0.30::DOUBLE) * 0.50::DOUBLE) AS BIGINT) AS want_val FROM "
            "(SELECT label, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM lab GROUP BY label)"
        ),
        "c2": share("n", "want", "c1", "n_train"),
        "c3": "SELECT label, n, want_val, n_train, n - n_train AS left_n FROM c2",
        "c4": share("left_n", "want_val", "c3", "n_validation"),
        "plan": (
            "SELECT label, n, CAST(n_train AS BIGINT) AS n_train, CAST(n_validation AS BIGINT) AS n_validation, "
            "CAST(left_n - n_validation AS BIGINT) AS n_test FROM c4"
        ),
        "parts": (
            "SELECT id, label, CASE WHEN k <= n_train THEN 'train' WHEN k <= n_train + n_validation THEN 'validation' ELSE 'test' END AS split "
            "FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || id), id) AS k FROM lab) JOIN plan USING (label)"
        ),
    }


SILVER_SPLIT = "SELECT tweet_id AS id, intent AS label FROM silver WHERE intent <> 'UNCLEAR'"


@query("H7", lambda: compose("SELECT id AS tweet_id, label AS intent, split FROM parts", split_ctes(SILVER_SPLIT)))
def stratified_split(b: Book) -> DataFrame:
    rows = b.silver.filter(F.col("intent") != V.UNCLEAR).select("tweet_id", "intent")
    return sampling.stratified_split(rows, "intent", "tweet_id")


@query(
    "H7",
    lambda: compose("SELECT label, n, n_train, n_validation, n_test FROM plan", split_ctes("SELECT doc_id AS id, lang AS label FROM documents")),
)
def document_split_sizes(b: Book) -> DataFrame:
    return sampling.split_plan(b.table("documents"), "lang").select("label", "n", "n_train", "n_validation", "n_test")


@query(
    "D18",
    lambda: compose(
        "SELECT label, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'validation') AS validation, "
        "count(*) FILTER (split = 'test') AS test FROM parts GROUP BY label",
        split_ctes(SILVER_SPLIT),
    ),
)
def class_distribution_by_split(b: Book) -> DataFrame:
    rows = b.silver.filter(F.col("intent") != V.UNCLEAR).select("tweet_id", "intent")
    split = sampling.stratified_split(rows, "intent", "tweet_id")
    return metrics.class_distribution(split, "intent", "split", ["train", "validation", "test"])


@query(
    "H8, C2",
    lambda: compose(
        "SELECT tweet_id, parent_id FROM m WHERE parent_id IS NOT NULL ORDER BY md5('0:' || tweet_id), tweet_id LIMIT 2000"
    ),
)
def sample_of_replies(b: Book) -> DataFrame:
    replies = b.messages.filter(F.col("parent_id").isNotNull())
    return sampling.simple_sample(replies, "tweet_id", 2000, 0).select("tweet_id", "parent_id")


@query(
    "C2, H8",
    lambda: compose(
        "SELECT count(*) AS declared, count(*) FILTER (NOT dangling) AS resolved FROM (SELECT m.tweet_id, par.dangling FROM m JOIN par USING (tweet_id) "
        "WHERE m.parent_id IS NOT NULL ORDER BY md5('0:' || m.tweet_id), m.tweet_id LIMIT 2000)"
    ),
)
def sampled_parent_resolution(b: Book) -> DataFrame:
    replies = b.messages.filter(F.col("parent_id").isNotNull())
    sample = sampling.simple_sample(replies, "tweet_id", 2000, 0)
    return profile.parent_resolution_rate(b.messages, sample).select("declared", "resolved")


@query(
    "G3",
    lambda: compose(
        f"SELECT DISTINCT {reply_class('text')} AS reply_class FROM (SELECT * FROM r1 UNION ALL SELECT * FROM r2) WHERE is_support",
        SAMPLES,
    ),
)
def observed_reply_classes(b: Book) -> DataFrame:
    return reports.observed_classes(*both(b))


@query("G4", lambda: compose("SELECT root FROM rest", SAMPLES))
def candidates_outside_pool(b: Book) -> DataFrame:
    pool = sampling.sample_roots(b.stats, BRAND, POOL, 2024)
    return threads.qualifying_threads(b.stats, BRAND).select("root").exceptAll(pool)


@query(
    "G6",
    lambda: compose(
        "SELECT tweet_id FROM golden WHERE intent <> '' UNION SELECT tweet_id FROM review WHERE approved_intent <> ''"
    ),
)
def decided_ids(b: Book) -> DataFrame:
    from threadwright.operators.labels import decided_ids as ids

    return ids(b.golden_sheet, b.review_sheet)


def figures(sample: str) -> str:
    tags = [(name, matches("lower(text)", p)) for name, p in V.ISSUE_TAGS.items()]
    tags.append(("i_autocorrect_bug", glitch("text")))
    size = f"(SELECT root, count(*) AS size FROM {sample} GROUP BY root)"
    parts = [
        f"SELECT 'stats' AS section, 'n_threads_sampled' AS item, CAST(count(*) AS DOUBLE) AS value FROM {size}",
        f"SELECT 'stats', 'mean_thread_len', avg(size) FROM {size}",
        f"SELECT 'stats', 'median_thread_len', CAST(quantile_cont(size, 0.5) AS DOUBLE) FROM {size}",
        f"SELECT 'stats', 'pct_exactly_2_turns', avg(CAST(size = 2 AS INT)) * 100 FROM {size}",
        f"SELECT 'stats', 'pct_3plus_turns', avg(CAST(size >= 3 AS INT)) * 100 FROM {size}",
        f"SELECT 'stats', 'pct_4plus_turns', avg(CAST(size >= 4 AS INT)) * 100 FROM {size}",
        f"SELECT 'stats', 'n_customer_messages', CAST(count(*) AS DOUBLE) FROM {sample} WHERE is_customer",
        f"SELECT 'stats', 'n_support_messages', CAST(count(*) AS DOUBLE) FROM {sample} WHERE is_support",
        f"SELECT 'canned', 'n_canned', CAST(count(*) AS DOUBLE) FROM {sample} WHERE is_support AND contains(lower(text), {q(V.CANNED_FRAGMENT)})",
    ]
    parts += [
        f"SELECT 'tag', '{name}', CAST(count(*) FILTER ({c}) AS DOUBLE) FROM {sample} WHERE is_customer" for name, c in tags
    ]
    parts += [
        f"SELECT 'reply', '{name}', CAST(count(*) FILTER ({reply_class('text')} = '{name}') AS DOUBLE) FROM {sample} WHERE is_support"
        for name in V.REPLY_CLASSES
    ]
    return " UNION ALL ".join(parts)


FIGURES = {"f1": figures("r1"), "f2": figures("r2")}
COMPARED = (
    "SELECT f1.section, f1.item, round(f1.value, 6) AS sample1, round(f2.value, 6) AS sample2 "
    "FROM f1 JOIN f2 ON f1.section = f2.section AND f1.item = f2.item"
)


@query("D16", lambda: compose(COMPARED, {**SAMPLES, **FIGURES}))
def sample_comparison(b: Book) -> DataFrame:
    table = reports.compare_samples(*both(b))
    return table.withColumns({c: F.round(c, 6) for c in ("sample1", "sample2")})


@query(
    "K7",
    lambda: compose(
        COMPARED
        + " UNION ALL SELECT 'overlap', 'threads', CAST(count(*) AS DOUBLE), CAST(count(*) AS DOUBLE) FROM d1 JOIN d2 USING (root)",
        {**SAMPLES, **FIGURES},
    ),
)
def replication_report(b: Book) -> DataFrame:
    table = reports.replication_report(b.threads, BRAND, N)
    return table.withColumns({c: F.round(c, 6) for c in ("sample1", "sample2")})
