"""Duplicate search against brute force, on awkward documents and on whole small tables."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from threadwright.llm import components, embeddings, jaccard, signatures, substrings, suffixes
from threadwright.llm.runindex import RunIndex, common_prefix, suffix_array

from . import brute
from .fixtures import SCHEMA, rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def pairs():
    return [(r[0], r[1]) for r in rows()]


def by_id(df, *names):
    return [(r[0], tuple(r[n] for n in names)) for r in df.collect()]


def test_passages_equal_brute_force(docs, pairs):
    found = by_id(substrings.remove_repeated_passages(docs, columns=["doc_id"]), "n_words", "n_removed", "kept_sha256")
    want = brute.passages(pairs)
    assert len(found) == len(pairs) and all(want[i] == got for i, got in found)
    assert sum(got[1] for _, got in found) > 1000


def test_passages_do_not_depend_on_hashes(docs, pairs, monkeypatch):
    """All windows share one hash: the automata and the words themselves still find the right ones."""
    monkeypatch.setattr(substrings, "window_hashes", lambda words, at, size, seed=0: np.zeros(len(at), np.uint64))
    found = by_id(substrings.remove_repeated_passages(docs, columns=["doc_id"]), "n_words", "n_removed", "kept_sha256")
    want = brute.passages(pairs)
    assert len(found) == len(pairs) and all(want[i] == got for i, got in found)


def test_automaton_rejects_what_only_shares_a_place(spark):
    """A stretch dealt to a block that does not hold it loses nothing and names its hash."""
    block, other = (b" ".join(b"%s%d" % (w, i) for i in range(20)) for w in (b"a", b"b"))
    rows = [(5, 1, 0, -1, block), (5, 2, 0, 7, block[3:]), (5, 3, 0, 0, other), (5, 1, 9, 0, block)]
    parts = spark.createDataFrame(rows, "place long, doc long, body long, at long, text binary").coalesce(1)
    got = substrings.located(parts, 13).collect()
    assert [(r.doc, r.body, r.begin, r.end) for r in got if r.key is None] == [(2, 0, 7, 26)]
    assert len([r for r in got if r.key is not None]) == 16


def test_passages_of_rows_that_share_an_id(spark, monkeypatch):
    monkeypatch.setattr(substrings, "CROWD", 2)
    rng = random.Random(3)
    texts = [" ".join(rng.choices(["a", "b", "c"], k=400)) + f" {i} " + " ".join(f"w{j}" for j in range(i, i + 600)) for i in range(6)]
    rows = [(1, texts[0]), (1, texts[1]), (1, texts[0]), (2, texts[1]), (2, texts[2]), (2, texts[1] + " " + texts[0]), (3, texts[0]), (3, texts[3])]
    rows += [(4, "x " * 3000), (5, "x " * 2000), (5, None)]
    first = {}
    for doc, text in rows:
        w = brute.words(text)
        for k in range(len(w) - 12):
            first[tuple(w[k : k + 13])] = min(doc, first.get(tuple(w[k : k + 13]), doc))
    want = []
    for doc, text in rows:
        w = brute.words(text)
        cut = {k + j for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < doc for j in range(13)}
        want.append((doc, len(w), len(cut)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r.doc_id, r.n_words, r.n_removed) for r in substrings.remove_repeated_passages(docs).collect()]
    assert sorted(got) == sorted(want)


def test_passages_rewrite_only_texts_that_lose_words(docs):
    cut = substrings.remove_repeated_passages(docs.withColumnRenamed("lang", "n_removed").withColumnRenamed("source", "passages"))
    assert cut.columns == ["doc_id", "text", "passages", "n_chars", "n_words", "n_removed", "kept_sha256"]
    before = {r.doc_id: r.text for r in docs.collect()}
    for r in cut.collect():
        assert r.text == before[r.doc_id] if r.n_removed == 0 else len(brute.words(r.text)) == r.n_words - r.n_removed


def test_long_strings_equal_brute_force(docs, pairs):
    out = suffixes.remove_repeated_bytes(docs, columns=["doc_id"], with_kept=True)
    found = by_id(out, "n_bytes", "n_removed", "n_spans", "kept_sha256")
    want = brute.long_strings(pairs)
    assert len(found) == len(pairs) and all(want[i] == got for i, got in found)
    assert all(len(r.kept) == r.n_bytes - r.n_removed for r in out.collect())


def test_long_strings_end_with_their_document(spark):
    rng = random.Random(11)
    p, q = ("".join(rng.choices("abcdefghij", k=60)) for _ in range(2))
    texts = [p + q] * 4 + [q[:30] + "".join(rng.choices("klmnopqrst", k=80)) + p for _ in range(24)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    want = brute.long_strings(list(enumerate(texts)))
    assert dict(by_id(suffixes.remove_repeated_bytes(docs), "n_bytes", "n_removed", "n_spans", "kept_sha256")) == want


@pytest.mark.parametrize("step", [1, 2**58])
def test_long_strings_across_blocks(spark, monkeypatch, step):
    """Blocks of a few rows, ids far apart, rows that share an id and rows without one."""
    monkeypatch.setattr(suffixes, "BLOCK", 600)
    rng = random.Random(4)
    base = ["".join(rng.choices("abcdé", k=rng.choice([50, 70, 140]))) for _ in range(12)]
    texts = [(rng.randint(-30, 30), "".join(rng.choice(base)[rng.randint(0, 9) :] for _ in range(rng.randint(0, 4)))) for _ in range(120)]
    rows = [(i * step, t) for i, t in texts] + [(None, base[0] * 2), (5 * step, None), (7 * step, "a" * 3000), (9 * step, "a" * 2000)]
    first = {}
    for doc, text in rows:
        raw = (text or "").encode()
        for k in range(len(raw) - 49):
            if doc is not None:
                first[raw[k : k + 50]] = min(doc, first.get(raw[k : k + 50], doc))
    want = []
    for doc, text in rows:
        raw = (text or "").encode()
        hit = [k for k in range(len(raw) - 49) if doc is not None and first[raw[k : k + 50]] < doc]
        want.append((doc, len(raw), len({k + j for k in hit for j in range(50)})))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r.doc_id, r.n_bytes, r.n_removed) for r in suffixes.remove_repeated_bytes(df).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_block_asks_once_for_a_common_string():
    """A string that many documents share is asked for by the first and the last of them."""
    text = " ".join(f"word{i}" for i in range(40)).encode()
    p = suffixes.Pieces(np.frombuffer(text * 500, np.uint8), np.arange(501) * len(text), 50, 24)
    deal = suffixes.Deal(0, 500, 1 << 20, 1)
    asked = suffixes.questions(3, p.anchor, p.piece, np.arange(500, dtype=np.uint64)[p.piece_row], deal)
    records, _ = suffixes.unpacked(asked.column("blob"), deal.question)
    assert len(p.piece) > 5000 and len(records) == 2 * len(np.unique(p.piece)) and set(records["doc"].tolist()) == {0, 499}


def test_strings_of_one_key_stay_apart(spark):
    """Pieces that share their key and half of their hash are told apart; the first document learns that there are several."""
    deal = suffixes.Deal(0, 9, 1, 1)
    key, sub, doc = (np.array(x, np.uint64) for x in ([7] * 4 + [8], [1, 2, 1, 2, 3], [4, 5, 6, 2, 1]))
    asked = [suffixes.questions(b, key[[i]], sub[[i]], doc[[i]], deal) for b, i in enumerate(range(5))]
    rows = [(r["bucket"], r["block"], r["blob"]) for q in asked for r in q.to_pylist()]
    table = suffixes.answered(spark.createDataFrame(rows, suffixes.QUESTIONS), deal, "test-answers")
    got = {r.block: np.frombuffer(r.blob, deal.answer).tolist() for r in table.collect()}
    assert got == {0: [(1, 4, 1)], 1: [(2, 2, 1)], 2: [(1, 4, 1)], 3: [(2, 2, 1)]}


def test_index_is_walked_by_pieces(monkeypatch):
    """A step of the index goes over a piece, not over a byte, and every byte of the copies is found."""
    walked = []
    pointers = RunIndex.pointers
    monkeypatch.setattr(RunIndex, "pointers", lambda self, *a: (walked.append(pointers(self, *a)), walked[-1])[1])
    text = "".join(random.Random(2).choices("abcdefgh", k=4000)).encode()
    p = suffixes.Pieces(np.frombuffer(text * 2, np.uint8), np.array([0, 4000, 8000]), 50, 24)
    deal = suffixes.Deal(0, 9, 1, 1)
    answers = np.zeros(len(np.unique(p.piece)), deal.answer)
    answers["sub"], answers["first"] = np.unique(p.piece), 3
    covered = suffixes.marked(p, np.array([3, 5], np.uint64), answers, answers[:0])
    assert not covered[:4000].any() and covered[4000:].all()
    assert 0 < sum(len(at) for at, _ in walked) < 4000 / 8


def test_near_copies_equal_brute_force(docs, pairs):
    found = by_id(jaccard.jaccard_groups(docs), "n_shingles", "component_id")
    want = brute.near_copies(pairs)
    assert len(found) == len(pairs) and all(want[i] == got for i, got in found)
    assert len({got[1] for _, got in found}) < len(want) - 20


def test_block_parts_lose_no_link(docs, pairs, monkeypatch):
    monkeypatch.setattr(jaccard, "PART", 4)
    want = brute.near_copies(pairs)
    assert all(want[i] == got for i, got in by_id(jaccard.jaccard_groups(docs), "n_shingles", "component_id"))


def test_null_ids_and_empty_tables(spark, docs):
    nothing = docs.limit(0)
    assert jaccard.jaccard_groups(nothing).count() == 0
    assert substrings.remove_repeated_passages(nothing).count() == 0
    assert suffixes.remove_repeated_bytes(nothing).count() == 0
    text = " ".join(f"word{i}" for i in range(40))
    nulls = spark.createDataFrame([(None, text), (1, text), (2, text), (None, None)], "doc_id long, text string")
    lost = {(r.doc_id, r.n_removed) for r in substrings.remove_repeated_passages(nulls).collect()}
    assert lost == {(None, 0), (1, 0), (2, 40)}
    lost = {(r.doc_id, r.n_removed) for r in suffixes.remove_repeated_bytes(nulls).collect()}
    assert lost == {(None, 0), (1, 0), (2, len(text))}
    assert sorted(map(tuple, jaccard.jaccard_groups(nulls).collect()), key=str) == sorted([(1, 36, 1), (2, 36, 1), (None, 36, None), (None, 0, None)], key=str)


def vectors():
    rng = np.random.default_rng(5)
    centre = rng.normal(size=16)
    out = [centre + rng.normal(scale=s, size=16) for s in np.linspace(0.01, 0.6, 60)]
    out += [rng.normal(size=16) for _ in range(40)] + [centre * 3] * 5
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(out)]
    bad = [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [1.0, 2.0], [1.0, 2.0]]
    return rows + [(1000 + i, v) for i, v in enumerate(bad)]


@pytest.mark.parametrize("tile", [7, 8192])
def test_vectors_equal_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(embeddings, "TILE_ROWS", tile)
    rows = vectors()
    df = spark.createDataFrame([*rows, rows[3], (None, [1.0] * 16)], "vec_id long, embedding array<double>")

    def fine(v):
        return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    of = dict(rows)

    def linked(a, b):
        x, y = of[a], of[b]
        return fine(x) and fine(y) and len(x) == len(y) and np.dot(x, y) / np.linalg.norm(x) / np.linalg.norm(y) >= 0.9

    want = brute.closure(list(of), linked)
    links = {a: sum(linked(a, b) for b in of if b != a) for a in of}
    got = embeddings.near_duplicates(df).collect()
    assert sorted(r.vec_id for r in got if r.vec_id is not None) == sorted([*of, rows[3][0]])  # one row per row
    assert [tuple(r) for r in got if r.vec_id is None] == [(None, 0, None, True)]
    for r in (r for r in got if r.vec_id is not None):
        assert (r.n_links, r.component_id, r.kept) == (links[r.vec_id], want[r.vec_id], want[r.vec_id] == r.vec_id)
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_int8_bound_holds():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 24))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    q, scale, norm, error = embeddings.quantise(unit)
    near = (q.astype(float) @ q.T.astype(float)) * np.outer(scale, scale)
    assert (np.abs(unit @ unit.T - near) <= norm[:, None] * error[None, :] + error[:, None] + 1e-12).all()


@pytest.mark.parametrize("same", [True, False])
def test_possible_rows_lose_no_pair_and_leave_most_out(same):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(900, 32))
    x[400:430] = x[10] + rng.normal(scale=0.12, size=(30, 32))  # cosines around the threshold
    sides = [np.arange(900)] * 2 if same else [np.arange(500), np.arange(500, 900)]
    if not same:
        x[500:530] = x[400:430] + rng.normal(scale=0.12, size=(30, 32))
    unit = embeddings.unit_rows(x)
    tiles = []
    for at in sides:
        q, *bounds = embeddings.quantise(unit[at])
        tiles.append(embeddings.Tile(at.astype(np.int64).tobytes(), q.tobytes(), np.stack(bounds).tobytes()))
    of_a, of_b = embeddings.possible_rows(*tiles, same, 0.9)
    link = unit[sides[0]] @ unit[sides[1]].T >= 0.9
    if same:
        np.fill_diagonal(link, False)
    assert link.any() and set(np.flatnonzero(link.any(axis=1))) <= set(of_a) and set(np.flatnonzero(link.any(axis=0))) <= set(of_b)
    assert len(of_a) < 100 and len(of_b) < 100


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(100, 164)]
    star = [(7, i) for i in range(200, 260)]
    links = [*chain, *star, (5, 5), (300, 301), (301, 300), (302, 301), (None, 4)]
    got = {r.id: r.component for r in components.components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    want = {i: 100 for i in range(100, 165)} | {i: 7 for i in [7, *range(200, 260)]} | {300: 300, 301: 300, 302: 300}
    assert got == want


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6))
def test_signature_tree_names_every_link(seed):
    rng = random.Random(seed)
    sets = []
    for _ in range(rng.randint(2, 70)):
        base = rng.choice(sets) if sets and rng.random() < 0.7 else set()
        sets.append({x for x in base if rng.random() < 0.9} | {rng.getrandbits(64) for _ in range(rng.choice([1, 3, 40, 90]))})
    tokens = [np.array(sorted(s), np.uint64) for s in sets]
    sizes = np.array([len(s) for s in sets])
    maps = [signatures.bitmap(t, int(w)) for t, w in zip(tokens, signatures.width_of(sizes), strict=True)]
    named = {tuple(sorted(p)) for a, b in signatures.block_pairs(np.arange(len(sets)), sizes, maps, 75) for p in zip(a.tolist(), b.tolist(), strict=True)}
    block = np.arange(len(sets)) // 9
    a, b = signatures.small_block_pairs(block, sizes, maps, 75)
    small = {tuple(sorted(p)) for p in zip(a.tolist(), b.tolist(), strict=True)}
    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                assert (j, i) in named
                assert block[i] != block[j] or (j, i) in small


@settings(max_examples=40, deadline=None)
@given(st.text("ab", min_size=1, max_size=80), st.lists(st.text("abc", max_size=60), max_size=5))
def test_run_index_matching_statistics(text, queries):
    limit = 16
    body = np.frombuffer(text.encode(), np.uint8)
    order = suffix_array(np.append(body, np.uint8(0xFE)))
    raw = text.encode() + b"\xfe"
    assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
    index = RunIndex(body, limit)
    data = "".join(queries).encode()
    ends = np.cumsum([len(q) for q in queries]).astype(np.int64) if queries else np.zeros(0, np.int64)
    begins = ends - np.array([len(q) for q in queries], np.int64) if queries else ends
    padded = np.concatenate([np.frombuffer(data, np.uint8), np.full(limit + 16, 0xFF, np.uint8)])
    at, place = index.pointers(padded, begins, ends)
    for a, p in zip(at.tolist(), place.tolist(), strict=True):
        stop = int(ends[np.searchsorted(ends, a, side="right")])
        longest = max((n for n in range(min(limit, stop - a) + 1) if data[a : a + n] in text.encode()), default=0)
        got = int(common_prefix(np.concatenate([padded[:stop], np.full(limit + 16, 0xFF, np.uint8)]), np.array([a]), index.padded, np.array([p]), limit)[0])
        assert min(got, limit) >= longest
