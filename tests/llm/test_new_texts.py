"""Fill-in-the-middle, whitening and decontamination on awkward rows, against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from threadwright.llm import decontamination, middle, whitening

from .fixtures import SCHEMA, rows

BLANK = r"\x20\x09-\x0D"
UNIT = re.compile(f"[{BLANK}]*[^{BLANK}]+|[{BLANK}]+")
AWKWARD = st.text(st.sampled_from("ab é€𝄞 \t\n\x0b\x0c\r\x08\x0e\x1c\x85\xa0 <PSM>\x00\x7f"), max_size=40)


# --- fill in the middle -------------------------------------------------------------------


def brute_middle(doc_id, text: str | None, seed: int = 42, percent: int = 50, spm: int = 80) -> tuple:
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    n = len(units)
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= percent:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def arranged(texts: list[str], ids: list, percent: int, spm: int) -> list[tuple]:
    data = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64)
    h = middle.draws([None if i is None else str(i) for i in ids], 42)
    plain = (h[:, 2] % 100 >= percent) | np.array([bool(re.search("<[PSM]>", t)) for t in texts])
    made = middle.arrange(np.frombuffer(b"".join(data), np.uint8), offsets, plain, h, spm)
    return list(zip(*(c.to_pylist() for c in made), strict=True))


@settings(max_examples=300, deadline=None)
@given(st.lists(AWKWARD, min_size=1, max_size=6), st.integers(0, 10**9), st.sampled_from([0, 50, 100]))
def test_middle_of_any_text(texts, first, spm):
    ids = [first + i for i in range(len(texts))]
    assert arranged(texts, ids, 100, spm) == [brute_middle(i, t, 42, 100, spm) for i, t in zip(ids, texts, strict=True)]


def test_every_byte_is_classified():
    data = np.arange(256, dtype=np.uint8)
    blank = np.unpackbits(middle.blank_bytes(middle.view_words(data)).view(np.uint8)[:256, None], axis=1)[:, 0]
    assert set(np.flatnonzero(blank)) == {0x20, *range(0x09, 0x0E)}
    starts = middle.point_starts(middle.view_words(data)).view(np.uint8)[:256] >> 7
    assert set(np.flatnonzero(starts == 0)) == set(range(0x80, 0xC0))


def test_rank_and_select_agree():
    rng = np.random.default_rng(5)
    flags = rng.random(1000) < 0.3
    marks = middle.Marks(middle.view_words((flags * 0x80).astype(np.uint8)) & np.uint64(0x8080808080808080))
    at = np.flatnonzero(flags)
    assert (marks.select(np.arange(1, len(at) + 1)) == at).all()
    assert (marks.rank(np.arange(1001)) == np.concatenate([[0], np.cumsum(flags)])).all()


def test_middle_of_a_table(spark):
    texts = {r[0]: r[1] for r in rows()}
    extra = [(None, "no id at all", "en", None, 1), (9001, "has <M> inside", "en", None, 1), (9002, "a <", "en", None, 1)]
    extra += [(9100 + i, "　x  y\tz <S <P M> " * (i + 1), "en", None, 1) for i in range(40)]
    given_rows = [*rows(), *extra]
    texts |= {r[0]: r[1] for r in extra}
    docs = spark.createDataFrame(given_rows, SCHEMA).withColumn("n", F.lit("clash")).repartition(3)
    made = middle.fill_in_middle(docs).withColumn("back", middle.restored(F.col("output"), F.col("form"))).collect()
    assert sorted(str(r.doc_id) for r in made) == sorted(str(r[0]) for r in given_rows)
    for r in made:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == brute_middle(r.doc_id, texts[r.doc_id])
        assert r.back == (texts[r.doc_id] or "")
    assert {"plain", "psm", "spm"} == {r.form for r in made} and made[0].source is not None
    assert middle.fill_in_middle(docs.limit(0)).count() == 0


# --- whitening ----------------------------------------------------------------------------


def brute_whitening(vectors: np.ndarray, most: int = 8):
    x = np.floor(1024 * vectors).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, units = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:most]
    values, units = values[order], units[:, order]
    return ((n * x - sums) ** 2).sum(axis=1), centred @ units / np.sqrt(values), values / np.trace(centred.T @ centred / n)


@pytest.mark.parametrize("dims,block", [(12, 7), (3, 4096)])
def test_whitening_equals_numpy(spark, dims, block):
    rng = np.random.default_rng(dims)
    vectors = rng.normal(size=(200, dims)) * np.linspace(1, 3, dims)
    vectors[150:] = vectors[:50]  # repeated vectors, under other ids
    given_rows = [(i, v.tolist(), 1.0) for i, v in enumerate(vectors)]
    bad = [None, [], [None] * dims, [float("nan")] + [0.0] * (dims - 1), [float("inf")] * dims, [1.0] * (dims + 1), [1e300] * dims]
    schema = "vec_id long, embedding array<double>, whitened double"
    df = spark.createDataFrame(given_rows + [(1000 + i, v, 0.0) for i, v in enumerate(bad)], schema).repartition(5)
    got = sorted(whitening.whiten(df, block_rows=block).collect())
    assert [r.vec_id for r in got] == list(range(200))
    deviations, whitened, explained = brute_whitening(vectors)
    assert [r.deviation for r in got] == deviations.tolist() and {r.n for r in got} == {200}
    mine = np.array([r.whitened for r in got])
    signs = np.sign((mine * whitened).sum(axis=0))
    assert abs(mine - whitened * signs).max() < 1e-9
    assert np.allclose(got[0].explained, explained, rtol=1e-10) and got[0].identity_error < 1e-9
    assert abs(np.cov(mine.T, bias=True) - np.eye(mine.shape[1])).max() == pytest.approx(got[0].identity_error, abs=1e-9)


def test_whitening_without_variance_or_rows(spark):
    schema = "vec_id long, embedding array<float>"
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(4)], schema)
    for df in (same, same.limit(1), same.limit(0), spark.createDataFrame([(1, None)], schema)):
        assert whitening.whiten(df).collect() == []
    line = spark.createDataFrame([(None, [0.0, 1.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [5.0, 1.0])], schema)
    got = whitening.whiten(line).collect()  # one component, a null id and a repeated row
    assert sorted(str(r.vec_id) for r in got) == ["1", "1", "2", "None"] and all(len(r.whitened) == 1 for r in got)


def test_deviation_of_wide_entries(spark):
    """Squares beyond 64 bits are exact where the sum fits, and null where it does not."""
    df = spark.createDataFrame([(0, [0.0, 0.0]), (1, [2.0**24, 0.0]), (2, [2.0**40, 3.0])], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.deviation for r in whitening.whiten(df).collect()}
    assert got == {0: None, 1: None, 2: None}
    x = spark.createDataFrame([([3, 5],)], "x array<bigint>")
    wide = whitening.deviation(F.col("x"), 10, [7, 9], 0, 1 << 60)  # forced into decimals
    assert x.select(wide).first()[0] == (30 - 7) ** 2 + (50 - 9) ** 2


# --- decontamination ----------------------------------------------------------------------


def folded(text: str | None) -> list[str]:
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute_passages(docs: list[tuple], items: list[tuple], size: int = 10) -> dict:
    found: dict[tuple, set] = {}
    for name, *texts in items:
        for words in map(folded, texts):
            for i in range(max(len(words) - size + 1, min(len(words), 1))):
                found.setdefault(tuple(words[i : i + size]), set()).add("" if name is None else str(name))
    out = {}
    for doc_id, text in docs:
        words, hit, names = folded(text), set(), set()
        for length in {len(w) for w in found}:
            for i in range(len(words) - length + 1):
                if names_of := found.get(tuple(words[i : i + length])):
                    hit |= set(range(i, i + length))
                    names |= names_of
        out[doc_id] = (len(words), len(hit), sorted(names))
    return out


def contaminated(seed: int = 11) -> tuple[list[tuple], list[tuple]]:
    rng = random.Random(seed)
    items = [(i, " ".join(rng.choice(["Ünd", "a", "B", "c3", "x-y"]) for _ in range(rng.randint(1, 40)))) for i in range(30)]
    items += [(30, None), (31, " .. "), (32, "Solo!"), (33, "solo"), (2, "another text under id two, solo"), (None, "nameless item"), items[4]]
    docs: list[tuple] = [(0, None), (1, ""), (2, "...\x00\x7f"), (3, "SOLO"), (4, "solos nameless, ITEM"), (5, "c3 " * 5000)]
    for i in range(6, 60):
        words = [rng.choice(["ünd", "a", "b", "c3", "x", "y", "zz"]) for _ in range(rng.randint(0, 80))]
        item = rng.choice(items)[1] or ""
        at = rng.randrange(len(words) + 1)
        docs.append((i, " ; ".join(words[:at]) + " — " + item.upper().replace("Ü", "Ü") + "\n" + "/".join(words[at:])))
    return docs, items


@pytest.mark.parametrize("limit", [decontamination.LIMIT, 4000])
def test_passages_equal_brute_force(spark, limit):
    docs, items = contaminated()
    docs += [(70, " ".join(f"q{i}" for i in range(20_000)) + " solo"), (None, "an item without id: solo")]
    df = spark.createDataFrame([*docs, docs[7]], "doc_id long, text string").withColumn("items", F.lit("clash")).repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string").repartition(4)
    got = decontamination.find_benchmark_passages(df, bench, limit=limit).collect()
    want = brute_passages(docs, items)
    assert sorted(str(r.doc_id) for r in got) == sorted(str(d[0]) for d in [*docs, docs[7]])
    texts = dict(docs)
    for r in got:
        assert (r.n_words, r.n_hit, r.items) == want[r.doc_id]
        assert r.n_hit == sum(run.length for run in r.word_runs)
        words = folded(texts[r.doc_id])
        for run, span in zip(r.word_runs, r.spans, strict=True):
            piece = texts[r.doc_id][span.start : span.start + span.length]
            assert folded(piece) == words[run.start : run.start + run.length] and folded(piece[0]) and folded(piece[-1])
    assert any(r.n_hit for r in got)


def test_questions_and_answers_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "well, paris it is"), (2, "rome")], "doc_id long, text string")
    bench = spark.createDataFrame([("q1", "capital of france", "Paris"), ("q2", None, None)], "item string, question string, answer string")
    args = {"item_id_col": "item", "item_text_cols": ["question", "answer"]}
    got = {r.doc_id: r.items for r in decontamination.find_benchmark_passages(docs, bench, **args).collect()}
    assert got == {1: ["q1"], 2: []}
    assert {r.n_hit for r in decontamination.find_benchmark_passages(docs, bench.limit(0), **args).collect()} == {0}
    assert decontamination.find_benchmark_passages(docs.limit(0), bench, **args).count() == 0


def test_fold_keeps_every_other_byte():
    assert [b for b in range(256) if decontamination.FOLD[b] != 32] == [*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]
    assert pa.array(list(decontamination.windows([b"a", b"b"], 3))).to_pylist() == [b" a b "]
