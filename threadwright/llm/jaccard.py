"""N-gram Jaccard join: documents that share most of their word n-grams, by signature trees.

Documents with equal sets are one. In one global order of all tokens (very frequent ones last,
else by hash) two sets that reach the threshold share several tokens among their first ones; so blocks of
documents with a common leading token hold every link, and documents with too few leading tokens
that anyone else has can be left out. Inside a block a signature tree names the
pairs that may link, and those are compared exactly. This is done twice:

1. on a few random leading tokens per document, with the sets at hand, so that dense groups (near
   copies of one text) grow together with about one comparison per document, not one per pair;
2. on all leading tokens, with bitmaps only and just between documents that are not connected yet;
   candidates are then compared exactly. This makes the result complete.

A block that many documents share is cut into parts; in the second pass every pair of parts is
compared, as a task of bounded size.

Defined results: a null or blank text has no set and links with nothing; fewer words than an n-gram
make one token of the whole. Ties (exactly at the threshold) link. A row without an id links with nothing: it comes
back with the size of its set and no component.
Repeated rows of one id are one document, listed as often. Two tokens are equal if
their 64-bit hashes are, two sets if 128-bit fingerprints are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, mix, release, staged, text_chunks, utf8, window_hashes
from .components import Forest, components
from .signatures import LEAF, bitmap, block_pairs, small_block_pairs, width_of
from .substrings import distinct_pairs, listed

PART = 512  # documents of a block part
LEADS = 2  # random leading tokens of the first pass
FIRSTS = 8  # of a document's keys that travel with it, so that a pair is named once and not in every common block
EXTRA = 20  # one leading token more for this many tokens: links then share that many more
HOT_SHARE = 0.001  # share of all documents from which a token counts as very frequent
_SALT = np.uint64(0xD6E8FEB86659FD93)


def ngram_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, token) pairs of the texts, sorted by row and token."""
    data, offsets = utf8(column)
    lower = data.copy()
    lower[(data >= 65) & (data <= 90)] += 32
    words = Words(lower, offsets)
    hashes = words.hashes()
    at = words.windows(size)
    rows, keys = [words.row[at]], [window_hashes(hashes, at, size)]
    for n in range(1, size):
        short = np.flatnonzero(words.counts == n)
        rows.append(short)
        keys.append(window_hashes(hashes, words.first[short], n, seed=10 + n))
    return distinct_pairs(np.concatenate(rows), np.concatenate(keys))


def _per_row(row: np.ndarray, n_rows: int) -> np.ndarray:
    return np.searchsorted(row, np.arange(n_rows + 1))


def set_rows(texts: DataFrame, size: int, percent: int, hot: np.ndarray) -> DataFrame:
    """Per document: number of tokens, fingerprint, and its leading tokens in the global order."""

    def rows(batches):
        for batch in text_chunks(batches, "text"):
            row, key = ngram_sets(batch.column("text"), size)
            first = _per_row(row, batch.num_rows)
            n = np.diff(first)
            total = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(key ^ s))]) for s in (np.uint64(0), _SALT)]
            marks = [(t[first[1:]] - t[first[:-1]]).view(np.int64) for t in total]
            if len(hot):
                slot = np.minimum(np.searchsorted(hot, key), len(hot) - 1)
                order = np.lexsort((key, hot[slot] == key, row))
                key = key[order]
            leading = np.minimum(n, n + (-percent * n) // 100 + 1 + n // EXTRA)
            place = np.arange(len(key)) - np.repeat(first[:-1], n)
            lead = key[place < np.repeat(leading, n)].view(np.int64)
            lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(leading)]).astype(np.int32), pa.array(lead))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(n), pa.array(marks[0]), pa.array(marks[1]), lists], names=["doc", "n", "f", "g", "leading"]
            )

    return texts.mapInArrow(rows, "doc long, n long, f long, g long, leading array<long>")


def frequent_tokens(texts: DataFrame, size: int, documents: int) -> np.ndarray:
    """Tokens that stand out as very frequent, sorted; they only steer the order of tokens.

    Each chunk reports tokens that several of its documents share; sums below ``HOT_SHARE`` of all
    documents are left out, so there are at most (mean set size / HOT_SHARE) of them.
    """

    def counts(batches):
        for batch in text_chunks(batches, "text"):
            _, key = ngram_sets(batch.column("text"), size)
            token, n = np.unique(key, return_counts=True)
            many = n >= 3
            yield pa.RecordBatch.from_pydict({"key": token[many].view(np.int64), "n": n[many].astype(np.int64)})

    found = texts.mapInArrow(counts, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    rows = found.filter(F.col("n") >= max(20.0, HOT_SHARE * documents)).select("key").toPandas()
    return np.sort(rows["key"].to_numpy(np.int64).view(np.uint64))


def _blocks(batches: Iterator[pa.RecordBatch], keys: list[str], limit: int = 4096) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by ``keys``."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < limit:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        last = np.ones(rows, dtype=bool)
        for k in keys:
            column = table.column(k).to_numpy()
            last &= column == column[-1]
        cut = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
        if cut:
            yield table.slice(0, cut)
        held, rows = table.slice(cut).to_batches(), rows - cut
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def _maps(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in column.to_pylist()]


def _candidates(table: pa.Table, keys: list[str], percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of the same block that may link, each block by its signature tree."""
    edge = np.zeros(table.num_rows, dtype=bool)
    edge[0] = True
    for k in keys:
        column = table.column(k).to_numpy()
        edge[1:] |= column[1:] != column[:-1]
    block = np.cumsum(edge) - 1
    sizes, maps = table.column("n").to_numpy(), _maps(table.column("bits"))
    counts = np.bincount(block)
    small = np.flatnonzero(counts[block] <= LEAF)
    if len(small):
        i, j = small_block_pairs(block[small], sizes[small], [maps[k] for k in small.tolist()], percent)
        if len(i):
            yield small[i], small[j]
    for b in np.flatnonzero(counts > LEAF).tolist():
        at = np.flatnonzero(block == b)
        yield from block_pairs(at, sizes[at], [maps[k] for k in at.tolist()], percent)


def _reaches(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)



def grouped_sets(texts: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of all documents, and (``doc``, ``component``) of the distinct sets that may have links."""
    documents = texts.count()
    hot = frequent_tokens(texts, size, documents)
    rows = staged(set_rows(texts, size, percent, hot), "sets")
    prints = staged(rows.select("doc", "n", "f", "g"), "fingerprints")
    distinct = prints.filter("n > 0").groupBy("f", "g", "n").agg(F.min("doc").alias("doc")).select("doc")
    posts = rows.join(distinct.hint("shuffle_hash"), "doc", "left_semi").select("doc", "n", F.explode("leading").alias("key"))
    posts = staged(posts, "posts")
    release(rows)
    seen = posts.groupBy("key").agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.count(F.lit(1)).alias("count"))
    seen = staged(seen.filter("first < last").select("key", F.ceil(F.col("count") / PART).cast("int").alias("parts")), "shared-keys")
    release(spark=texts.sparkSession)
    found = staged(posts.join(seen, "key"), "found-posts")
    release(posts, seen)
    # two linked sets share 1 + (size of the smaller) / EXTRA leading tokens at least
    enough = F.count(F.lit(1)) >= 1 + F.expr(f"(max(n) * {percent}) div {100 * EXTRA}")
    involved = staged(found.groupBy("doc").agg(enough.alias("enough")).filter("enough").select("doc"), "involved")
    shared = staged(found.join(involved.hint("shuffle_hash"), "doc", "left_semi").select("doc", "key", "parts"), "shared-posts")
    release(found)

    def set_table(batches):
        for batch in text_chunks(batches, "text"):
            row, key = ngram_sets(batch.column("text"), size)
            first = _per_row(row, batch.num_rows)
            n = np.diff(first)
            widths = width_of(n).tolist()
            tokens = [key[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
            lead = [np.sort(mix(t ^ _SALT))[:LEADS].view(np.int64).tolist() for t in tokens]
            bits = [bitmap(t, w).tobytes() for t, w in zip(tokens, widths, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(n), pa.array(bits, pa.binary()), pa.array([t.tobytes() for t in tokens], pa.binary()), pa.array(lead, pa.list_(pa.int64()))],
                names=["doc", "n", "bits", "tokens", "lead"],
            )

    schema = "doc long, n long, bits binary, tokens binary, lead array<long>"
    sets = staged(texts.join(involved.hint("shuffle_hash"), "doc", "left_semi").mapInArrow(set_table, schema), "token-sets")
    release(spark=texts.sparkSession)

    # first pass: a few random leading tokens, exact comparison in the block, one link per union
    leads = sets.select("doc", F.explode("lead").alias("key"))
    often = leads.groupBy("key").agg(F.count(F.lit(1)).alias("count")).filter("count > 1")
    dealt = leads.join(often, "key").select("doc", "key", F.pmod(F.xxhash64("doc", "key"), F.ceil(F.col("count") / PART)).alias("part"))
    blocks = dealt.hint("shuffle_hash").join(sets.select("doc", "n", "bits", "tokens"), "doc")

    def grow(batches):
        for table in _blocks(batches, ["key", "part"]):
            doc = table.column("doc").to_numpy()
            tokens = [np.frombuffer(x, np.uint64) for x in table.column("tokens").to_pylist()]
            # positions of one document in several blocks are one node
            node = np.unique(doc, return_inverse=True)[1].tolist()
            forest, tried, a, b = Forest(len(node)), set(), [], []
            for left, right in _candidates(table, ["key", "part"], percent):
                for i, j in zip(left.tolist(), right.tolist(), strict=True):
                    pair = (node[i], node[j])
                    if doc[i] == doc[j] or pair in tried or forest.root(pair[0]) == forest.root(pair[1]):
                        continue
                    tried.add(pair)
                    if _reaches(tokens[i], tokens[j], percent):
                        forest.join(*pair)
                        a.append(int(doc[i]))
                        b.append(int(doc[j]))
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    sorted_blocks = blocks.repartition("key", "part").sortWithinPartitions("key", "part", "doc")
    grown = staged(sorted_blocks.mapInArrow(grow, "a long, b long"), "grown-links")
    group = staged(components(grown, "a", "b"), "groups")
    release(spark=texts.sparkSession)

    # second pass: all leading tokens, only between what is not connected yet
    labels = sets.select("doc", "n", "bits").join(group, F.col("doc") == F.col("id"), "left").select("doc", "n", "bits", F.coalesce("component", "doc").alias("group"))
    labels = staged(labels, "labels")
    named = shared.join(labels.select("doc", "group"), "doc")
    mixed = named.groupBy("key").agg(F.min("group").alias("lo"), F.max("group").alias("hi")).filter("lo < hi").select("key")
    named = staged(shared.join(mixed.hint("shuffle_hash"), "key", "left_semi"), "open-posts")
    firsts = named.groupBy("doc").agg(F.slice(F.array_sort(F.collect_list("key")), 1, FIRSTS).alias("firsts"))
    known = staged(labels.join(firsts, "doc"), "open-labels")
    release(spark=texts.sparkSession)
    part = F.pmod(F.xxhash64("doc", "key"), F.col("parts")).cast("int")
    named = named.withColumn("own", part).withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
    named = named.select("doc", "key", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"))
    remaining = named.hint("shuffle_hash").join(known, "doc")

    def name_pairs(batches):
        for table in _blocks(batches, ["key", "p", "q"]):
            doc, of, key = (table.column(c).to_numpy() for c in ("doc", "group", "key"))
            firsts = np.full((len(doc), FIRSTS), np.iinfo(np.int64).max)
            row, value = listed(table.column("firsts").combine_chunks())
            firsts[row, np.arange(len(row)) - np.searchsorted(row, row)] = value
            for left, right in _candidates(table, ["key", "p", "q"], percent):
                apart = of[left] != of[right]
                left, right = left[apart], right[apart]
                # a smaller common key names the pair in its own block
                a, b = firsts[left][:, :, None], firsts[right][:, None, :]
                once = ~((a == b) & (a < key[left][:, None, None])).any(axis=(1, 2))
                left, right = left[once], right[once]
                low = doc[left] < doc[right]
                a, b = np.where(low, left, right), np.where(low, right, left)
                if len(a):
                    yield pa.RecordBatch.from_pydict({"a": doc[a], "b": doc[b], "of_a": of[a], "of_b": of[b]})

    sorted_rest = remaining.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q", "doc")
    schema = "a long, b long, of_a long, of_b long"
    pairs = staged(sorted_rest.mapInArrow(name_pairs, schema).distinct(), "candidate-pairs")
    release(spark=texts.sparkSession)
    tokens = sets.select("doc", "tokens")
    both = pairs.join(tokens.select(F.col("doc").alias("a"), F.col("tokens").alias("x")), "a").join(
        tokens.select(F.col("doc").alias("b"), F.col("tokens").alias("y")), "b"
    )

    def compare(batches):
        for batch in batches:
            fine = [
                _reaches(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True)
            ]
            yield batch.select(["of_a", "of_b"]).filter(pa.array(fine, pa.bool_()))

    # what the second pass links are groups, so its links are few however large the groups are
    rest = both.select("of_a", "of_b", "x", "y").mapInArrow(compare, "of_a long, of_b long").distinct()
    outer = components(rest, "of_a", "of_b").select(F.col("id").alias("group"), F.col("component").alias("whole"))
    final = labels.join(outer, "group", "left").select("doc", F.coalesce("whole", "group").alias("component")).distinct()
    return prints, staged(final, "set-groups")


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 75) -> DataFrame:
    """``id_col``, ``n_shingles`` and ``component_id`` of every document."""
    texts = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    prints, groups = grouped_sets(texts, size, percent)
    group = groups.withColumnRenamed("doc", "rep")
    classes = prints.filter("n > 0").groupBy("f", "g", "n").agg(F.min("doc").alias("rep")).join(group, "rep", "left")
    classes = classes.select("f", "g", "n", F.coalesce("component", "rep").alias("component_id"))
    known = prints.filter("n > 0").join(classes, ["f", "g", "n"]).select("doc", "n", "component_id")
    blank = prints.filter("n = 0").select("doc", "n", F.col("doc").alias("component_id"))
    unnamed = docs.filter(F.col(id_col).isNull()).select(F.lit(None).cast("long").alias("doc"), F.col(text_col).alias("text"))
    unnamed = set_rows(unnamed, size, percent, np.zeros(0, np.uint64)).select("doc", "n", F.col("doc").alias("component_id"))
    return known.unionByName(blank).unionByName(unnamed).select(F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), "component_id")
