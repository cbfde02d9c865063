"""Metrics, judge aggregation, label sheets, gates and sources on small hand-written rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadwright.operators import classifier, judge, labels, metrics, quality
from threadwright.sources import labels as label_source
from threadwright.sources import messages as source
from threadwright.sources import sinks, staging


def pairs(spark, rows):
    return spark.createDataFrame(rows, "t string, p string")


def test_zero_division_is_zero(spark):
    df = pairs(spark, [("a", "a"), ("a", "b"), ("b", "a"), ("c", "a")])
    got = {r.label: (round(r.precision, 4), r.recall, round(r.f1, 4), r.support) for r in metrics.per_class_metrics(df, "t", "p", ["a", "b", "c", "d"]).collect()}
    assert got == {"a": (0.3333, 0.5, 0.4, 2), "b": (0.0, 0.0, 0.0, 1), "c": (0.0, 0.0, 0.0, 1), "d": (0.0, 0.0, 0.0, 0)}
    fixed = metrics.summary_metrics(df, "t", "p", ["a", "b", "c", "d"]).first()
    seen = metrics.summary_metrics(df, "t", "p").first()
    assert (fixed.accuracy, round(fixed.macro_f1, 4), round(fixed.weighted_f1, 4)) == (0.25, 0.1, 0.2)
    assert round(seen.macro_f1, 4) == 0.1333
    matrix = metrics.confusion_matrix(df, "t", "p", ["a", "b"]).orderBy("truth_index", "prediction_index")
    assert [r.n for r in matrix.collect()] == [1, 1, 1, 0]


def test_binary_without_positive_predictions(spark):
    df = pairs(spark, [("AUTO", "ESC"), ("ESC", "ESC")])
    assert tuple(metrics.binary_metrics(df, "t", "p", "AUTO").first()) == (0.5, 0.0, 0.0, 0.0)


def test_agreement_matches_numpy_and_survives_constant_raters(spark):
    rng = np.random.default_rng(1)
    human, machine = rng.integers(1, 6, 50), rng.integers(1, 6, 50)
    rows = [(int(h), int(m), 5, int(m)) for h, m in zip(human, machine)]
    df = spark.createDataFrame(rows, "h int, m int, c int, d int")
    got = {r.dimension: r for r in judge.agreement(df, [("x", "h", "m"), ("flat", "c", "m"), ("same", "d", "m")]).collect()}
    assert got["x"].pearson_r == pytest.approx(np.corrcoef(human, machine)[0, 1])
    assert got["x"].mean_abs_diff == pytest.approx(np.abs(human - machine).mean())
    assert got["flat"].pearson_r is None and got["flat"].t is None
    assert got["same"].exact_rate == 1.0 and got["same"].pearson_r == pytest.approx(1.0)
    one = judge.agreement(df.limit(1), [("x", "h", "m")]).first()
    assert one.n == 1 and one.pearson_r is None
    assert judge.agreement(df.limit(0), [("x", "h", "m")]).first().exact_rate is None


@pytest.mark.parametrize("n", [2, 9, 10, 57])
def test_representative_rows_equal_sorting(spark, n):
    rows = [(i * 37 % 1009, float(i * 7 % 4)) for i in range(n)]
    ordered = sorted(rows, key=lambda r: (r[1], r[0]))
    at = np.linspace(n * 0.35, n * 0.65, 4).astype(int).clip(0, n - 1)
    want = list(dict.fromkeys([*ordered[:3], *[ordered[i] for i in at], *ordered[-3:]]))[:10]
    df = spark.createDataFrame(rows, "tweet_id bigint, overall double")
    got = [(r.tweet_id, r.overall) for r in judge.representative_rows(df, id_buckets=8).collect()]
    assert sorted(got) == sorted(want)


def test_low_quartile_keeps_ties(spark):
    df = spark.createDataFrame([(i, 1.0 if i < 6 else 2.0) for i in range(10)], "tweet_id int, overall double")
    assert judge.low_quartile(df).count() == 6


def test_weakest_dimension_prefers_the_first_on_ties(spark):
    df = spark.createDataFrame([(3, 2, 2, 5)], "relevance int, groundedness int, helpfulness int, safety int")
    assert judge.weakest_dimension(df).first().dimension == "groundedness"


SHEET = "tweet_id bigint, intent string, expected_response_behavior string, expected_handling string, labeling_notes string"
REVIEW = (
    "tweet_id bigint, proposed_intent string, proposed_response_behavior string, proposed_handling string, labeling_reason string, "
    "approved_intent string, approved_response_behavior string, approved_handling string, labeling_notes string"
)


def test_upsert_touches_only_undecided_rows(spark):
    golden = spark.createDataFrame([(1, "", "", "", ""), (2, "X", "x", "E", "hand"), (3, "", "", "", ""), (4, "", "", "", "")], SHEET)
    review = spark.createDataFrame(
        [
            (1, "A", "a", "E", "why", "", "", "", ""),
            (2, "B", "b", "E", "why", "", "", "", ""),
            (3, "C", "c", "E", "why", "Z", "z", "E", "seen"),
        ],
        REVIEW,
    )
    merged = {r.tweet_id: (r.intent, r.labeling_notes) for r in labels.apply_labels(golden, review).collect()}
    assert merged == {1: ("A", "why"), 2: ("X", "hand"), 3: ("", ""), 4: ("", "")}
    marked = {r.tweet_id: (r.approved_intent, r.labeling_notes[:13]) for r in labels.mark_approved(golden, review).collect()}
    assert marked == {1: ("A", "Auto-approved"), 2: ("", ""), 3: ("Z", "seen")}
    known = labels.provenance(golden, labels.mark_approved(golden, review)).first()
    assert (known.n_approved, known.n_overridden, known.n_bulk, known.n_human) == (2, 1, 1, 3)
    # running it again changes nothing
    again = labels.apply_labels(labels.apply_labels(golden, review), labels.mark_approved(golden, review))
    assert sorted(again.collect()) == sorted(labels.apply_labels(golden, review).collect())


def test_gates_count_and_raise(spark):
    raw = spark.createDataFrame([("1",), ("x",), ("1",), (None,)], "tweet_id string")
    assert quality.non_numeric_ids(raw).first().n_bad_ids == 2
    assert quality.repeated_ids(raw).first().n_duplicates == 1
    with pytest.raises(quality.QualityError, match="n_bad_ids"):
        quality.require(quality.non_numeric_ids(raw), "ids")
    quality.require(quality.non_numeric_ids(raw.limit(0)), "ids")
    left = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    right = spark.createDataFrame([(2,), (3,)], "k int")
    assert tuple(quality.not_one_to_one(left, right, "k").first()) == (1, 1, 1)
    scores = spark.createDataFrame([(1,), (6,), (None,)], "s int")
    assert quality.scores_out_of_range(scores, "s").first().bad_s == 2


def test_csv_round_trip_keeps_odd_texts(spark, tmp_path):
    rows = [
        ("1", "a", "True", "t", 'quote " and, comma', None, None),
        ("2", "b", "False", "t", "two\nlines", "3,4", "1"),
        ("3", "NA", "True", None, " padded ", None, "nan"),
    ]
    raw = spark.createDataFrame(rows, source.RAW_SCHEMA)
    path = str(tmp_path / "csv")
    sinks.write_table(raw, path, "csv")
    assert sorted(source.read_messages(spark, path).collect(), key=str) == sorted(raw.collect(), key=str)
    assert [r.x for r in raw.select(source.child_ids(F.col("response_tweet_id")).alias("x")).collect()] == [None, [3, 4], None]


def test_label_sheet_keeps_blanks(spark, tmp_path):
    df = spark.createDataFrame([("1", "", "note"), ("2", "X", "")], "tweet_id string, intent string, n string")
    sinks.write_table(df, str(tmp_path / "s"), "csv")
    got = label_source.read_labels(spark, str(tmp_path / "s"), ["tweet_id", "intent", "n"])
    assert sorted(got.collect()) == sorted(df.collect())
    assert labels.progress(got, "intent").first().asDict() == {"total": 2, "done": 1, "remaining": 1}


def test_json_array_records(spark, tmp_path):
    (tmp_path / "p.json").write_text('[{"tweet_id": 1, "intent": "X", "confidence": "high", "reason": "r"},\n {"tweet_id": 2}]')
    got = label_source.read_json_records(spark, str(tmp_path), label_source.PROPOSAL_SCHEMA).orderBy("tweet_id").collect()
    assert [(r.tweet_id, r.intent) for r in got] == [(1, "X"), (2, None)]


def test_customer_lines_are_flat(spark, tmp_path, messages):
    df = messages([(1, None, "a", "c", 1, "one\ntwo"), (2, 1, "B", "s", 2, "reply")])
    sinks.write_customer_lines(df, str(tmp_path / "t"))
    assert [r.value for r in spark.read.text(str(tmp_path / "t")).collect()] == ["one two"]


def test_build_or_load_builds_once(spark, tmp_path):
    path, calls = str(tmp_path / "x"), []

    def build():
        calls.append(1)
        return spark.range(3)

    assert sinks.build_or_load(spark, path, build).count() == 3
    assert sinks.build_or_load(spark, path, build).count() == 3
    assert calls == [1]


def test_staging_uses_the_sessions_folder(spark):
    root = staging.staging_root(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert root.startswith(configured.rstrip("/"))
    path = staging.new_path(spark, "x")
    spark.range(1).write.parquet(path)
    assert staging.path_exists(spark, path)
    staging.drop_path(spark, path)
    assert not staging.path_exists(spark, path)


def test_scope_discards_what_was_staged_inside(spark):
    outside = staging.stage(spark.range(2), "outer")
    with staging.staged_scope():
        inside = staging.stage(spark.range(2), "inner")
        table = staging.stage_bucketed(spark.range(2), "inner_table", "id", 2)
        places = [staging._LOCATIONS[df] for df in (inside, table)]
        assert table.count() == inside.count() == 2
    assert not any(staging.path_exists(spark, path) for path, _ in places)
    assert not spark.catalog.tableExists(places[1][1])
    assert outside.count() == 2


def test_parsed_times(spark):
    df = spark.createDataFrame([("Tue Oct 31 22:10:47 +0000 2017",), ("Tue Oct 31 22:10:47 +0200 2017",), ("x",), (None,)], "c string")
    got = [r.s for r in df.select(F.unix_seconds(source.parse_created_at(F.col("c"))).alias("s")).collect()]
    assert got == [1509487847, 1509480647, None, None]


def test_classifier_trains_predicts_and_survives_saving(spark, tmp_path):
    rows = [(f"battery drains fast {i}", "power") for i in range(12)] + [(f"wifi will not connect {i}", "net") for i in range(6)]
    df = spark.createDataFrame(rows, "message string, intent string")
    model = classifier.train_classifier(df, "message", "intent", max_iter=50)
    got = classifier.predict(df, model).collect()
    assert all(r.predicted_intent == r.intent and 0.5 < r.confidence <= 1 for r in got)
    classifier.save_model(model, str(tmp_path / "m"))
    again = classifier.predict(df, classifier.load_model(str(tmp_path / "m"))).collect()
    assert [tuple(r) for r in again] == [tuple(r) for r in got]
    weights = {r.intent: r.weight for r in classifier.balanced_weights(df, "intent").collect()}
    assert weights == {"power": 0.75, "net": 1.5}


def test_large_vocabularies_are_hashed(spark, tmp_path):
    rows = [(f"battery drains fast {i} {i + 1}", "power") for i in range(20)] + [(f"wifi will not connect {i} {i + 1}", "net") for i in range(20)]
    df = spark.createDataFrame(rows, "message string, intent string")
    model = classifier.train_classifier(df, "message", "intent", max_iter=50, max_vocabulary=2, hash_slots=256)
    assert model.stages[1].getNumFeatures() == 256
    classifier.save_model(model, str(tmp_path / "m"))
    got = classifier.predict(df, classifier.load_model(str(tmp_path / "m"))).collect()
    assert all(r.predicted_intent == r.intent for r in got)
    assert classifier.vocabulary_size(spark.createDataFrame([(["a", "b", "a"],), (["a"],)], "terms array<string>"), 2) == 1


def test_calibration(spark):
    df = spark.createDataFrame([(0.2, False), (0.3, True), (0.9, True), (0.95, False)], "confidence double, correct boolean")
    got = [tuple(r) for r in classifier.calibration(df, [0.0, 0.25, 0.99]).collect()]
    assert got == [(0.0, 4, 1.0, 0.5), (0.25, 3, 0.75, 2 / 3), (0.99, 0, 0.0, None)]


@pytest.mark.parametrize(
    "df,t,p",
    # published two-sided critical values of Student's t, and the closed forms of one and two degrees of freedom
    [
        (1, 12.7062047364, 0.05), (2, 4.3026527297, 0.05), (5, 2.5705818366, 0.05), (10, 2.2281388520, 0.05), (30, 2.0422724563, 0.05),
        (120, 1.9799304051, 0.05), (1, 63.6567411629, 0.01), (10, 3.1692726726, 0.01), (60, 2.6602830289, 0.01), (10, 4.5868938587, 0.001),
        (1, 1.0, 0.5), (2, 2.0, 1 - 2 / 6**0.5), (7, 0.0, 1.0), (10**9, 1.9599639845, 0.05), (10**9, 0.6744897502, 0.5), (10**6, 3.2905267315, 0.001),
    ],
)
def test_correlation_p_value(spark, df, t, p):
    from threadwright.functions.special import correlation_p_value

    r = t / (df + t * t) ** 0.5
    got = spark.range(1).select(correlation_p_value(F.lit(r), F.lit(df + 2))).first()[0]
    assert got == pytest.approx(p, abs=1e-6)


def test_correlation_p_value_at_the_edges(spark):
    from threadwright.functions.special import correlation_p_value

    rows = [(0.3, 2, 1.0), (1.0, 5, 0.0), (-1.0, 3, 0.0), (None, 9, None), (0.5, 1, None), (0.0, 10, 1.0)]
    df = spark.createDataFrame(rows, "r double, n long, want double")
    assert all(row.got == row.want for row in df.withColumn("got", correlation_p_value(F.col("r"), F.col("n"))).collect())
    halves = spark.createDataFrame([(0.6, 8), (-0.6, 8)], "r double, n long")
    a, b = (row[0] for row in halves.select(correlation_p_value(F.col("r"), F.col("n"))).collect())
    assert a == b == pytest.approx(1 - 0.6 * (1 + 0.64 / 2 + 0.64**2 * 3 / 8), abs=1e-12)  # closed form of 6 degrees


def test_lowest_scored_rows(spark):
    df = spark.createDataFrame([(3, 2.0), (1, 2.0), (2, 1.0), (4, None), (5, 9.0)], "tweet_id long, overall double")
    assert [r.tweet_id for r in judge.lowest_scored(df).collect()] == [2, 1, 3, 5, 4]
    assert [r.tweet_id for r in judge.lowest_scored(df, n=2).collect()] == [2, 1]


def test_balanced_weights_leave_rows_of_one_class_spread(spark):
    rows = spark.createDataFrame([(i, "a" if i else "b") for i in range(400)], "id long, intent string").repartition(4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        weighted = classifier.balanced_weights(rows, "intent").withColumn("part", F.spark_partition_id())
        found = weighted.filter("intent = 'a'").groupBy("part").count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(found) == 4 and sum(r["count"] for r in found) == 399
    assert {r["intent"]: r["weight"] for r in weighted.collect()} == {"a": 400 / (2 * 399), "b": 200.0}


def test_array_lines_need_no_sort_and_stay_one_array(spark, tmp_path):
    import json

    records = spark.range(0, 25_000, 1, 7).select(F.to_json(F.struct(F.col("id").alias("tweet_id"), F.lit("a } \" b").alias("intent"))).alias("value"))
    path = str(tmp_path / "one")
    lines = records.coalesce(1).mapInArrow(sinks.array_lines, "value string")
    assert "Sort" not in lines._jdf.queryExecution().executedPlan().toString()
    lines.write.text(path)
    (part,) = (tmp_path / "one").glob("part-*")
    assert sorted(r["tweet_id"] for r in json.loads(part.read_text())) == list(range(25_000))
    got = label_source.read_json_records(spark, path, label_source.PROPOSAL_SCHEMA)
    assert got.count() == 25_000 and got.filter("intent <> 'a } \" b'").count() == 0
    assert records.filter("value IS NULL").coalesce(1).mapInArrow(sinks.array_lines, "value string").count() == 0


def held(rows, spark):
    return spark.createDataFrame(rows, "message string, intent string").repartition(3)


def test_classifier_keeps_every_term(spark):
    """More terms than the vocabulary once was cut at: none shares a feature, and all come with their coefficients."""
    words = [f"term{i}" for i in range(1400)]
    rows = [(" ".join(words[i % 70 :: 70]), "ab"[i % 2]) for i in range(140)] + [(None, "a"), ("lost", None), ("", "b")]
    model = classifier.train_classifier(held(rows, spark), "message", "intent", max_iter=5)
    terms = [t for r in model.terms.collect() for t in r.terms.split("\n")]
    assert len(terms) == len(set(terms)) == 1400 + 70 * 19
    assert all(len(r.weights) == 2 * len(r.idf) for r in model.terms.collect())


def test_classifier_equals_the_library(spark, monkeypatch):
    """Terms dealt out to several parts, rows in several slices: steps and probabilities are those of spark.ml."""
    from threadwright.operators import logistic

    monkeypatch.setattr(logistic, "TASK_BYTES", 200)
    monkeypatch.setattr(logistic, "SLICE", 50)
    monkeypatch.setattr(logistic, "PIECE", 40)
    topics = {"power": "battery charge drains fast", "net": "wifi router connect slow", "bill": "invoice refund charge slow"}
    rows = [(f"{' '.join(t.split()[i % 4 :])} {'please' * (i % 2)} day{i % 7} day{i % 5}", name) for name, t in topics.items() for i in range(12 + len(t) % 9)]
    rows += [(rows[3][0], "bill"), (None, "net"), ("nothing known", "net"), ("battery", None)]
    df = held(rows, spark)
    # the same features by the library: so many slots that no two terms share one
    slots = classifier.train_classifier(df, "message", "intent", min_df=1, max_iter=20, max_vocabulary=1, hash_slots=1 << 18)
    ours = classifier.train_classifier(df, "message", "intent", min_df=1, max_iter=20)
    assert ours.parts > 3
    want, got = (sorted(map(tuple, classifier.predict(df, m).collect()), key=str) for m in (slots, ours))
    assert [r[:3] for r in got] == [r[:3] for r in want] and len(got) == len(rows)
    assert max(abs(a[3] - b[3]) for a, b in zip(got, want, strict=True)) < 1e-9
