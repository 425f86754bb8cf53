"""Evaluation texts inside a corpus, by latent semantic retrieval.

Texts are cut into overlapping passages of words. The passages' TF-IDF vectors, over the
vocabulary of the held-out items and with word counts from all passages of the corpus, are
reduced by a randomised SVD whose matrix products are partial sums of Spark tasks. Candidates
come from that latent space, and are checked word by word afterwards:

* Exact runs. Every window of ``run`` words, of an item as of the corpus, is projected in whole
  numbers, so that equal windows have equal latent vectors whatever surrounds them. The signs
  along random directions are its block; a corpus window is held against the item windows of its
  block only, and its words are compared. Equal windows always share a block, so no run is lost.
* Paraphrases. Corpus passages whose latent cosine with a passage of an item is at least
  ``near``; their longest common subsequence and the share of the item's answer that the
  document holds in order tell how much of the item is there.

A corpus passage of ``2*run`` words starts every ``run`` words, so every run of that many words
lies wholly within one. A passage with fewer than ``run`` words of the items' vocabulary can't
hold a run of an item and is not kept.

The items are the stated query set. They are searched in blocks of about ``block_chars``
characters, so the vocabulary and the latent vectors that the driver and a task hold are bounded
however many items there are; each block is one more pass over the corpus.

Defined results: null and empty texts and items match nothing; upper and lower case of ASCII
letters are equal, all but ASCII letters and digits separates words; a document with several
items, or an item in several documents, gives a row for each pair; rows with the same key give
one row; an empty table on either side gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.session import cut, spread

_WORD = re.compile(rb"[a-z0-9]+")
_GAP = re.compile(rb"[^a-z0-9]")
SLICE = 1 << 22  # bytes of a text that are cut into words at a time
HELD = 1 << 20  # words of corpus texts that are cut into passages at a time
BITS = 64  # signs that name a block of the latent space


def words(text: str | None) -> list[bytes]:
    """Longest runs of ASCII letters and digits; only ASCII letters are lower-cased."""
    return _WORD.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


def word_ids(text: str, vocab: dict[bytes, int]) -> list[np.ndarray]:
    """Numbers of the text's words, -1 for words of no item; long texts come in several arrays."""
    raw, get, out, at = text.encode("utf-8", "surrogatepass").lower(), vocab.get, [], 0
    while at < len(raw):
        end = at + SLICE
        if end < len(raw):
            gap = _GAP.search(raw, end)
            end = gap.start() if gap else len(raw)
        found = _WORD.findall(raw, at, end)
        out.append(np.fromiter((get(w, -1) for w in found), np.int32, len(found)))
        at = end
    return out


def windows_of(flat: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    return flat[starts[:, None] + np.arange(size)]


class Items:
    """A block of held-out items as sequences of word numbers, with their passages and windows."""

    def __init__(self, rows: list[tuple], run: int):
        self.run, self.vocab, self.parts = run, {}, []
        ids = []
        for item, *texts in rows:
            for kind, text in enumerate(texts):
                own = [self.vocab.setdefault(w, len(self.vocab)) for w in words(text)]
                if len(own) >= run:
                    self.parts.append((item, kind == len(texts) - 1))
                    ids.append(np.array(own, np.int32))
        # passages of 1.5 runs, a start every half run; texts are kept apart by unknown words
        half = max(1, run // 2)
        self.size = run + half
        pad = np.full(2 * run, -1, np.int32)
        self.flat = np.concatenate([x for own in ids for x in (own, pad)]) if ids else pad
        start, window, passage = 0, [], []
        for k, own in enumerate(ids):
            last = len(own) - run
            window += [(k, start + s) for s in range(last + 1)]
            passage += [(k, start + s) for s in range(0, max(1, last + half), half)]
            start += len(own) + len(pad)
        self.window_part, self.window_at = (np.array(x, np.int64) for x in (zip(*window) if window else ((), ())))
        self.passage_part, self.passage_at = (np.array(x, np.int64) for x in (zip(*passage) if passage else ((), ())))
        self.passages = windows_of(self.flat, self.passage_at, self.size)
        self.lengths = (self.passages >= 0).sum(axis=1)


def cut_passages(held: list[tuple[int, list[np.ndarray]]], run: int) -> tuple[np.ndarray, np.ndarray]:
    """Row of each passage, and the passages as one matrix filled up with -1."""
    pad = np.full(2 * run, -1, np.int32)
    size = np.array([sum(map(len, ids)) for _, ids in held])
    flat = np.concatenate([x for _, ids in held for x in (*ids, pad)])
    begin = np.cumsum(size + len(pad)) - size - len(pad)
    n = np.maximum(1, -(-(size - run) // run))
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    starts = np.repeat(begin, n) + within * run
    return np.repeat(np.array([r for r, _ in held]), n), windows_of(flat, starts, 2 * run)


def _passages(items):
    """Passages with enough words of the items; at the end the partition's word counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        it: Items = items.value
        n, vocab = it.run, it.vocab
        counts, seen, key_type = np.zeros(len(vocab) + 1, np.int64), 0, None
        names, lists = ["key", "ids", "counts"], pa.list_(pa.int32())

        def made(b: pa.RecordBatch, held: list) -> pa.RecordBatch:
            nonlocal seen
            row, x = cut_passages(held, n)
            seen += len(x)
            known = np.sort(x, axis=1)
            new = (known >= 0) & np.concatenate((np.ones((len(x), 1), bool), known[:, 1:] != known[:, :-1]), axis=1)
            counts[:-1] += np.bincount(known[new], minlength=len(vocab))
            keep = (x >= 0).sum(axis=1) >= n
            row, x = row[keep], x[keep]
            off = pa.array(np.arange(len(x) + 1, dtype=np.int32) * 2 * n)
            ids = pa.ListArray.from_arrays(off, pa.array(x.ravel()))
            return pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), ids, pa.nulls(len(x), pa.list_(pa.int64()))], names=names)

        for b in batches:
            key_type, held, size = b.schema.field(0).type, [], 0
            for i, text in enumerate(b.column(1)):
                ids = word_ids(text.as_py() or "", vocab)
                own = sum(map(len, ids))
                if own:
                    held.append((i, ids))
                    size += own
                if size > HELD:
                    yield made(b, held)
                    held, size = [], 0
            if held:
                yield made(b, held)
        if key_type is not None:
            counts[-1] = seen
            yield pa.RecordBatch.from_arrays([pa.nulls(1, key_type), pa.nulls(1, lists), pa.array([counts], pa.list_(pa.int64()))], names=names)

    return run


def project(x: np.ndarray, idf: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Latent vectors of TF-IDF passages of unit length, and the weight of each of their words.

    x: word numbers, filled up with -1. Only the words of a passage are touched.
    """
    w = np.where(x >= 0, idf[x], 0).astype(np.float32)
    times = (x[:, :, None] == x[:, None, :]).sum(axis=2)  # how often the word stands in its passage
    w /= np.maximum(np.sqrt((w * w * times).sum(axis=1, keepdims=True)), 1e-9)
    return np.einsum("ij,ijk->ik", w, basis[x]), w


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def product(x: np.ndarray, idf: np.ndarray, basis: np.ndarray, total: np.ndarray) -> None:
    """Adds A'A·Q of these passages to the words' rows of ``total``."""
    for s in range(0, len(x), 2048):
        part = x[s : s + 2048]
        z, w = project(part, idf, basis)
        known = part >= 0
        word = part[known]
        order = np.argsort(word, kind="stable")
        rows = (w[:, :, None] * z[:, None, :])[known][order]
        first = np.flatnonzero(np.diff(word[order], prepend=-1))
        if len(first):
            total[word[order][first]] += np.add.reduceat(rows, first, axis=0)


def _product(idf, basis, width: int):
    """Partial sums of A'A·Q over a partition's passages, a row for each word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, q = idf.value, basis.value
        total, any_row = np.zeros(q.shape), False
        for b in batches:
            if b.num_rows:
                any_row = True
                product(_matrix(b.column(0), width), w, q, total)
        if any_row:
            used = np.flatnonzero(np.abs(total).sum(axis=1))
            sums = pa.array(list(total[used]), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), sums], names=["word", "sums"])

    return run


def latent_basis(passages: DataFrame, items: Items, idf: np.ndarray, rank: int, extra: int = 8, rounds: int = 2, seed: int = 7) -> np.ndarray:
    """Leading right singular vectors of the passages' TF-IDF matrix, by randomised iteration.

    The matrix itself is never gathered: each round brings one row of rank+extra sums for each
    word of the block of items, whatever the size of the corpus.
    """
    sc = passages.sparkSession.sparkContext
    v = len(idf)
    k = min(v, rank + extra)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((v, k)))[0].astype(np.float32)
    for _ in range(rounds):
        sums = passages.select("ids").mapInArrow(_product(sc.broadcast(idf), sc.broadcast(q), 2 * items.run), "word int, sums array<double>")
        y = np.zeros((v, k))
        product(items.passages, idf, q, y)
        for r in sums.groupBy("word").agg(F.array(*[F.sum(F.col("sums")[j]) for j in range(k)]).alias("sums")).collect():
            y[r["word"]] += np.array(r["sums"])
        q = np.linalg.qr(y)[0].astype(np.float32)
    return q[:, : min(k, rank)]


class Blocks:
    """The items' windows by the block of the latent space that they lie in."""

    def __init__(self, items: Items, idf: np.ndarray, basis: np.ndarray, seed: int = 11):
        turned = (idf[:, None] * basis) @ np.random.default_rng(seed).standard_normal((basis.shape[1], BITS))
        scale = (1 << 24) / max(float(np.abs(turned).max()), 1e-9)
        # whole numbers: a window's sum is the same in whatever order it is added; -1 is nothing
        self.turned = np.concatenate((np.rint(turned * scale), np.zeros((1, BITS)))).astype(np.int32)
        self.run = items.run
        block = np.concatenate(
            [
                self.blocks(windows_of(items.flat, items.window_at[s : s + 4096], self.run))[2] for s in range(0, len(items.window_at), 4096)
            ]
        )
        order = np.argsort(block, kind="stable")
        self.block, self.first = np.unique(block[order], return_index=True)
        self.stop = np.append(self.first[1:], len(order))
        self.part, self.at = items.window_part[order], items.window_at[order]

    def blocks(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, start and block of each window without unknown words in rows of word numbers."""
        n = self.run
        run = np.cumsum(np.pad(self.turned[x], ((0, 0), (1, 0), (0, 0))), axis=1, dtype=np.int32)
        unknown = np.cumsum(np.pad(x < 0, ((0, 0), (1, 0))), axis=1)
        i, j = np.nonzero(unknown[:, n:] == unknown[:, :-n])
        return i, j, np.packbits(run[i, j + n] - run[i, j] > 0, axis=1).view(np.uint64).ravel()

    def exact(self, items: Items, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, part, place in the items) of every window that is one of an item, word for word."""
        i, j, block = self.blocks(x)
        at = np.minimum(np.searchsorted(self.block, block), len(self.block) - 1)
        hit = self.block[at] == block
        i, j, at = i[hit], j[hit], at[hit]
        n = self.stop[at] - self.first[at]
        k = np.repeat(self.first[at] - np.cumsum(n) + n, n) + np.arange(n.sum())
        i, j = np.repeat(i, n), np.repeat(j, n)
        span = np.arange(self.run)
        same = (x[i[:, None], j[:, None] + span] == items.flat[self.at[k][:, None] + span]).all(axis=1)
        return i[same], self.part[k[same]], self.at[k[same]]


def lcs(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, a word of bits at a time."""
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for y in b:
        u = row & where.get(y, 0)
        row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


_PAIRS = ["key", "item_id", "answer", "passage", "cosine", "exact", "lcs_share"]


def _search(items, idf, basis, blocks, near: float | None, block: int):
    """Pairs of a corpus passage and an item passage that the latent space brings together, checked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        it: Items = items.value
        w, q, by = idf.value, basis.value, blocks.value
        unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-9)
        own = unit(project(it.passages, w, q)[0]) if near is not None else None
        shares: dict[tuple[bytes, int], float] = {}

        def share(p: np.ndarray, c: int) -> float:
            known = (p.tobytes(), c)
            if known not in shares:
                if len(shares) > 1 << 18:
                    shares.clear()
                shares[known] = lcs(p[p >= 0].tolist(), it.passages[c, : it.lengths[c]].tolist()) / max(1, int(it.lengths[c]))
            return shares[known]

        for b in batches:
            for s in range(0, b.num_rows, 1024):
                x = _matrix(b.column(1).slice(s, 1024), 2 * it.run)
                i, part, place = by.exact(it, x)
                found = {(a, k): (1.0, True, 1.0) for a, k in set(zip(i.tolist(), (-1 - part).tolist()))}
                if near is not None:
                    z = unit(project(x, w, q)[0])
                    for first in range(0, len(own), block):
                        cos = z @ own[first : first + block].T
                        a, c = np.nonzero(cos >= near)
                        for r, k, v in zip(a.tolist(), (c + first).tolist(), cos[a, c].tolist()):
                            found[r, k] = (v, False, share(x[r], k))
                if not found:
                    continue
                # a pair with a whole part (an exact run) has no passage of its own
                parts = [it.parts[-1 - k if k < 0 else it.passage_part[k]] for _, k in found]
                value = list(zip(*found.values()))
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0).take(pa.array([s + a for a, _ in found], pa.int64())),
                        pa.array([p[0] for p in parts], pa.int64()),
                        pa.array([p[1] for p in parts], pa.bool_()),
                        pa.array([k for _, k in found], pa.int64()),
                        *[pa.array(v, t) for v, t in zip(value, (pa.float64(), pa.bool_(), pa.float64()))]
                    ],
                    names=_PAIRS
                )

    return run


def _block_leaks(docs: DataFrame, kind: str, rows: list[tuple], run: int, near: float | None, rank: int, block: int) -> DataFrame | None:
    """Checked pairs of the corpus with one block of items."""
    held = Items(rows, run)
    if not held.parts:
        return None
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast(held)
    found = cut(spread(docs).mapInArrow(_passages(shared), f"key {kind}, ids array<int>, counts array<bigint>"))
    totals = found.where("counts is not null").select(F.posexplode("counts").alias("word", "n")).groupBy("word").agg(F.sum("n").alias("n"))
    counts = np.zeros(len(held.vocab) + 1)
    for r in totals.collect():
        counts[r["word"]] = r["n"]
    idf = np.log((1 + counts[-1] + len(held.passages)) / (1 + counts[:-1])).astype(np.float32)
    passages = found.where("ids is not null").select("key", "ids")
    basis = latent_basis(passages, held, idf, rank)
    by = Blocks(held, idf, basis)
    sizes = {}  # passages of each item's answer
    for k in held.passage_part.tolist():
        item, answer = held.parts[k]
        sizes[item] = sizes.get(item, 0) + answer
    pairs = passages.mapInArrow(
        _search(shared, sc.broadcast(idf), sc.broadcast(basis), sc.broadcast(by), near, block),
        f"key {kind}, item_id bigint, answer boolean, passage bigint, cosine double, exact boolean, lcs_share double"
    )
    best = pairs.groupBy("key", "item_id", "answer", "passage").agg(*[F.max(c).alias(c) for c in ("cosine", "exact", "lcs_share")])
    answers = docs.sparkSession.createDataFrame([(i, n) for i, n in sizes.items() if i is not None], "item_id bigint, passages bigint")
    of_answer = F.sum(F.when(F.col("answer") & (F.col("passage") >= 0), F.col("lcs_share")).otherwise(0.0))
    each = best.groupBy("key", "item_id").agg(
        F.max("cosine").alias("cosine"),
        F.max("exact").alias("exact"),
        F.max(F.when(F.col("passage") >= 0, F.col("lcs_share"))).alias("lcs_share"),
        F.max(F.col("answer") & F.col("exact")).alias("exact_answer"),
        of_answer.alias("of_answer")
    )
    if near is None:
        return each.withColumn("answer_share", F.lit(0.0)).drop("of_answer")
    share = F.coalesce(F.col("of_answer") / F.nullif(F.col("passages"), F.lit(0)), F.lit(0.0))
    return each.join(answers, "item_id", "left").withColumn("answer_share", share).select("key", *[c for c in each.columns if c not in ("key", "of_answer")], "answer_share")


def find_leaks(
    docs: DataFrame,
    key: str,
    text: str,
    items: DataFrame,
    item: str,
    parts: list[str],
    run: int = 12,
    near: float | None = 0.7,
    rank: int = 64,
    block: int = 4096,
    block_chars: int = 2_000_000
) -> DataFrame:
    """(key, item_id, cosine, exact, lcs_share, exact_answer, answer_share) of documents and items in them.

    exact: the document has at least ``run`` words in a row that stand in a row in one part of
    the item; no threshold has a say in that. The other pairs are likely paraphrases: a passage
    whose latent cosine is at least ``near``, with the largest share of an item's passage that
    stands there in the same order. The last of ``parts`` is the item's answer: exact_answer
    tells of a run of it, answer_share is the mean over the answer's passages of the share that
    the document holds in order. With ``near`` None only exact pairs are looked for.
    """
    spark, kind = docs.sparkSession, docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).where("text is not null")
    held = items.select(F.col(item).cast("bigint").alias("item_id"), *[F.col(p).cast("string").alias(f"part{i}") for i, p in enumerate(parts)])
    texts = [f"part{i}" for i in range(len(parts))]
    chars = held.agg(F.sum(sum((F.coalesce(F.length(t), F.lit(0)) for t in texts), F.lit(0)))).first()[0] or 0
    blocks = max(1, -(-chars // block_chars))
    number = F.pmod(F.xxhash64("item_id", *texts), F.lit(blocks))
    found = []
    for n in range(blocks):
        mine = [tuple(r) for r in held.where(number == n).collect()]
        part = _block_leaks(rows, kind, mine, run, near, rank, block)
        if part is not None:
            found.append(part)
    if not found:
        return spark.createDataFrame(
            [], f"{key} {kind}, item_id bigint, cosine double, exact boolean, lcs_share double, exact_answer boolean, answer_share double"
        )
    # an item lies in one block only, unless the table gives its id to several texts
    out = reduce(DataFrame.unionByName, found)
    if blocks > 1:
        out = out.groupBy("key", "item_id").agg(
            *[F.max(c).alias(c) for c in ("cosine", "exact", "lcs_share", "exact_answer", "answer_share")]
        )
    return out.withColumnRenamed("key", key)
