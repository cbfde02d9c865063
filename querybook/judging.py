"""Reply-quality and rater-agreement queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadwright.functions import vocab as V
from threadwright.functions.scoring import overall_score
from threadwright.operators import judge
from threadwright.plans import evaluation

from .oracle import compose
from .registry import query
from .tables import Book

SCORES = [*V.JUDGE_DIMENSIONS, "overall"]
PAIRS = [(d, f"human_{d}", d) for d in V.JUDGE_DIMENSIONS]


@query("I17, I18", lambda: compose(f"SELECT tweet_id, {', '.join(SCORES)} FROM scored"))
def heuristic_scores(b: Book) -> DataFrame:
    return b.scored.select("tweet_id", *SCORES)


@query(
    "I18",
    lambda: compose(
        "SELECT tweet_id, round_even((CAST(human_relevance AS DOUBLE) + human_groundedness + human_helpfulness + human_safety) / 4, 2) AS overall FROM scored"
    ),
)
def human_overall(b: Book) -> DataFrame:
    return b.scored.select(
        "tweet_id", overall_score(*[F.col(f"human_{d}") for d in V.JUDGE_DIMENSIONS]).alias("overall")
    )


@query("C7", lambda: compose(f"SELECT tweet_id, predicted_handling, {', '.join(SCORES)} FROM scored"))
def joined_scores(b: Book) -> DataFrame:
    joined = judge.join_scores(b.predictions, b.scored.select("tweet_id", *SCORES))
    return joined.select("tweet_id", "predicted_handling", *SCORES)


@query(
    "D26",
    lambda: compose(
        "SELECT count(*) AS n_judged, " + ", ".join(f"round(avg({c}), 6) AS {c}" for c in SCORES) + " FROM scored"
    ),
)
def judge_averages(b: Book) -> DataFrame:
    return judge.average_scores(b.scored).withColumns({c: F.round(c, 6) for c in SCORES})


def by_sql(by: str) -> str:
    columns = ", ".join(f"round_even(avg({c}), 2) AS {c}" for c in SCORES)
    return compose(f"SELECT {by}, {columns} FROM scored GROUP BY {by}")


@query("D26", lambda: by_sql("predicted_response_behavior"))
def judge_averages_by_behavior(b: Book) -> DataFrame:
    return judge.average_scores_by(b.scored, "predicted_response_behavior")


@query("D26", lambda: by_sql("predicted_handling"))
def judge_averages_by_handling(b: Book) -> DataFrame:
    return judge.average_scores_by(b.scored, "predicted_handling")


@query(
    "D27",
    lambda: compose(
        "SELECT dimension, round(average, 6) AS average FROM ("
        + " UNION ALL ".join(f"SELECT {i} AS i, '{d}' AS dimension, avg({d}) AS average FROM scored" for i, d in enumerate(V.JUDGE_DIMENSIONS))
        + ") ORDER BY average, i LIMIT 1"
    ),
)
def weakest_dimension(b: Book) -> DataFrame:
    return judge.weakest_dimension(b.scored).withColumn("average", F.round("average", 6))


LOW = "overall <= (SELECT quantile_cont(overall, 0.25) FROM scored)"


@query("D28", lambda: compose(f"SELECT tweet_id, overall FROM scored WHERE {LOW}"))
def low_quartile_rows(b: Book) -> DataFrame:
    return judge.low_quartile(b.scored).select("tweet_id", "overall")


@query(
    "D28",
    lambda: compose(
        f"SELECT predicted_response_behavior, count(*) AS n FROM scored WHERE {LOW} GROUP BY predicted_response_behavior"
    ),
)
def low_quartile_behaviors(b: Book) -> DataFrame:
    return judge.low_quartile_distribution(b.scored)


@query(
    "D29",
    lambda: compose(
        "SELECT * FROM (WITH rated AS ("
        + " UNION ALL ".join(
            f"SELECT '{d}' AS dimension, count(*) AS n, avg(CAST(human_{d} = {d} AS INT)) AS e, avg(abs(human_{d} - {d})) AS d, "
            f"CASE WHEN count(DISTINCT human_{d}) > 1 AND count(DISTINCT {d}) > 1 THEN corr(human_{d}, {d}) END AS r FROM scored"
            for d in V.JUDGE_DIMENSIONS
        )
        # Student's t with a whole number of degrees of freedom has a closed form, a finite sum
        + "), stat AS (SELECT *, n - 2 AS v, r * sqrt((n - 2) / (1 - r * r)) AS t, atan(r / sqrt(1 - r * r)) AS angle FROM rated), "
        "term AS (SELECT dimension, v, angle, unnest(range(0, v // 2)) AS j FROM stat WHERE r IS NOT NULL), "
        "grown AS (SELECT *, sum(CASE WHEN j = 0 THEN 0 WHEN v % 2 = 0 THEN ln((2 * j - 1) / (2 * j)) ELSE ln(2 * j / (2 * j + 1)) END) "
        "OVER (PARTITION BY dimension ORDER BY j) AS factor FROM term), "
        "series AS (SELECT dimension, sum(exp(factor + (2 * j + v % 2) * ln(cos(angle)))) AS total FROM grown GROUP BY dimension) "
        "SELECT dimension, n, round(e, 6) AS exact_rate, round(d, 6) AS mean_abs_diff, round(r, 6) AS pearson_r, round(t, 4) AS t, "
        "round(CASE WHEN v % 2 = 0 THEN 1 - abs(sin(angle)) * total ELSE 1 - 2 / pi() * (abs(angle) + abs(sin(angle)) * total) END, 6) AS p_value "
        "FROM stat LEFT JOIN series USING (dimension))"
    ),
)
def rater_agreement(b: Book) -> DataFrame:
    table = judge.agreement(b.scored, PAIRS)
    return table.withColumns({c: F.round(c, 6) for c in ("exact_rate", "mean_abs_diff", "pearson_r", "p_value")}).withColumn(
        "t", F.round("t", 4)
    )


@query(
    "F6",
    lambda: compose(
        "SELECT tweet_id, CAST("
        + " + ".join(f"abs(human_{d} - {d})" for d in V.JUDGE_DIMENSIONS)
        + " AS BIGINT) AS total_diff FROM scored ORDER BY total_diff DESC, tweet_id LIMIT 5"
    ),
)
def largest_disagreements(b: Book) -> DataFrame:
    return judge.largest_disagreements(b.scored, PAIRS).select("tweet_id", "total_diff")


ORDERED = (
    "SELECT tweet_id, overall, row_number() OVER (ORDER BY overall, tweet_id) - 1 AS position, count(*) OVER () AS n FROM scored"
)


@query(
    "E7, G5",
    lambda: compose(
        "SELECT tweet_id, overall, position FROM (SELECT *, CASE WHEN position < 3 THEN 1 WHEN position IN ("
        + ", ".join(
            f"least(CAST(floor(n * 0.35::DOUBLE + {i} * ((n * 0.65::DOUBLE - n * 0.35::DOUBLE) / 3)) AS BIGINT), n - 1)" for i in range(3)
        )
        + ", least(CAST(floor(n * 0.65::DOUBLE) AS BIGINT), n - 1)) THEN 2 WHEN position >= n - 3 THEN 3 END AS grp FROM ordered) "
        "WHERE grp IS NOT NULL ORDER BY grp, position LIMIT 10",
        {"ordered": ORDERED},
    ),
)
def representative_rows(b: Book) -> DataFrame:
    return judge.representative_rows(b.scored).select("tweet_id", "overall", "position")


@query("F5", lambda: compose("SELECT tweet_id, overall FROM scored ORDER BY overall, tweet_id"))
def lowest_scored_rows(b: Book) -> DataFrame:
    return judge.lowest_scored(b.scored.select("tweet_id", "overall"))


@query("F5", lambda: compose("SELECT tweet_id, overall FROM scored ORDER BY overall, tweet_id LIMIT 20"))
def twenty_lowest_scored_rows(b: Book) -> DataFrame:
    return judge.lowest_scored(b.scored, n=20).select("tweet_id", "overall")


@query(
    "K4",
    lambda: compose(
        " UNION ALL ".join(
            [f"SELECT 'average' AS section, 'all' AS item, '{c}' AS metric, round(avg({c}), 6) AS value FROM scored" for c in SCORES]
            + [
                f"SELECT '{by}', {by}, '{c}', round_even(avg({c}), 2) FROM scored GROUP BY {by}"
                for by in ("predicted_response_behavior", "predicted_handling")
                for c in SCORES
            ]
            + [f"SELECT 'low_quartile', predicted_response_behavior, 'rows', CAST(count(*) AS DOUBLE) FROM scored WHERE {LOW} GROUP BY predicted_response_behavior"]
            + [
                "SELECT 'weakest', dimension, 'average', round(average, 6) FROM (SELECT * FROM ("
                + " UNION ALL ".join(f"SELECT {i} AS i, '{d}' AS dimension, avg({d}) AS average FROM scored" for i, d in enumerate(V.JUDGE_DIMENSIONS))
                + ") ORDER BY average, i LIMIT 1)"
            ]
        )
    ),
)
def judge_report(b: Book) -> DataFrame:
    scores = b.scored.select("tweet_id", *SCORES)
    return evaluation.judge_report(b.predictions, scores).withColumn("value", F.round("value", 6))
