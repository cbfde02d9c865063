"""The pipeline, stage by stage, against plain versions of its decisions."""

from __future__ import annotations

from collections import Counter, defaultdict

import duckdb
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from check_oracles import compare, connect
from tests.conftest import SF_DIR
from threadwright.llm import queries
from threadwright.llm.common import staged

from . import brute


def test_registered():
    names = [f"op{n}_" for n in range(1, 11)]
    registered = entry.queries()
    assert all(sum(q.startswith(n) for q in registered) == 1 for n in names) and "pipeline" in registered


def test_queries_equal_their_sql(spark):
    con = connect(SF_DIR)
    for name, sql in queries.LLM_SQL.items():
        assert compare(queries.LLM_QUERIES[name](spark, SF_DIR), con, sql()) == "", name


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES:
        steps.append(staged(stage(spark, steps[-1], SF_DIR), name))
    raw, known, distinct, cut, mixed, packed = ([tuple(r) for r in df.collect()] for df in steps)
    assert all(df.columns == columns for df in steps[:-1])

    # language: only rows without a known language go
    assert set(known) <= set(raw) and len(known) >= 0.98 * len(raw)
    # near duplicates: the smallest id of each group stays
    group = brute.near_copies([(r[0], r[1]) for r in known])
    assert sorted(distinct) == sorted(r for r in known if group[r[0]][1] == r[0])
    # passages: what is left
    want = brute.passages([(r[0], r[1]) for r in distinct])
    before = {r[0]: r for r in distinct}
    assert len(cut) == len(distinct)
    for doc, text, lang, source, n_chars in cut:
        assert (lang, source) == before[doc][2:4]
        if want[doc][1]:
            assert len(brute.words(text)) == want[doc][0] - want[doc][1] and n_chars == len(text)
        else:
            assert (text, n_chars) == (before[doc][1], before[doc][4])
    # mixing: as SQL chooses
    con = duckdb.connect()
    frame = steps[3].selectExpr("doc_id", f"{queries.DOMAIN} AS domain", "lang", "source", "coalesce(regexp_count(text, '[^\\\\x20\\\\x09-\\\\x0D]+'), 0) AS n_tokens").toPandas()
    con.register("frame", frame)
    chosen = con.execute(queries.mixing_sql("SELECT * FROM frame", corpus_pipeline.KEEP_SHARE, corpus_pipeline.KEEP_EPOCHS)).fetchall()
    assert Counter(r[0] for r in mixed) == Counter(r[0] for r in chosen)
    assert set(mixed) <= set(cut)
    # packing: every id of every document once per repetition
    tokenizer = Tokenizer.from_file(queries.vocabulary())
    lengths = {r[0]: len(brute.tokens(r[1], tokenizer)) for r in mixed}
    times = Counter(r[0] for r in mixed)
    at = {c: i for i, c in enumerate(steps[-1].columns)}
    total, spans = Counter(), defaultdict(int)
    for r in packed:
        total[r[at["doc_id"]]] += r[at["length"]]
        spans[r[at["sequence_id"]]] += r[at["length"]]
    assert total == {d: n * times[d] for d, n in lengths.items()}
    assert max(spans.values()) <= 4096


def test_near_duplicates_keep_rows_without_id(spark):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(None, "clean and alone in the table", "en", "s", 28), (None, text, "en", "s", 0), (1, text, "en", "s", 0), (2, text, "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.without_near_duplicates(spark, docs, SF_DIR).collect()
    assert Counter(tuple(r) for r in kept) == Counter(rows[:3])


def test_run_is_the_stages(spark):
    once = corpus_pipeline.run(spark, SF_DIR)
    assert once.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and once.count() > 100
