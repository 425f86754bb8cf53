"""Encoding of a corpus with a public byte-level BPE vocabulary, and decoding.

The encoder is a streaming transducer. Reading bytes from left to right it keeps, for each
position, the last token of the encoding of everything up to there: the longest token ending
there that is compatible with the last token at its own start. The part of an encoding before
any of its token boundaries is the encoding of that part of the text, so these last tokens
chain up to the encodings of all prefixes.

The sufficient lookahead is computed from the merge list. Whatever bytes follow the end of what
was read, the encoding of the longer text either has a boundary there, or a token across it; and
that token starts where the bytes up to the end are a proper prefix of some token. So the
encoding runs through one of these live positions, at most ``lookahead`` of them, the length of
the longest token less one, and through the chain of last tokens before it. A token is given out
as soon as the chains of all live positions share it: no later byte can change it then. Memory
stays constant however long the text is. Short pieces of text are looked up in a bounded cache
of what the transducer gave for them.

Defined results: an empty or null text has an empty list of ids; strings of special tokens
inside a text are ordinary text; a null document id is kept; decoding puts U+FFFD for bytes
that are not UTF-8, and skips ids that the vocabulary lacks; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import codecs
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.session import spread

# Fixed pattern: how this family of vocabularies splits text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARIES = {"byte_bpe_50k": "/opt/tokenizers/byte_bpe_50k.tiktoken", "byte_bpe_multi_50k": "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"}
PIECE = 1 << 16  # characters of a text that are split at a time
CACHED = 1 << 19  # pieces in the cache
SHORT = 64  # characters of a piece that may be cached


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to id; the ids are the order of the merges."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Transducer:
    """Streaming BPE over bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks))
        self.lookahead = self.longest - 1
        self.prefixes: set[bytes] | None = None
        self.lengths: dict[bytes, list[int]] = {}
        for t in ranks:  # lengths of the tokens that end with these two bytes, longest first
            self.lengths.setdefault(t[-2:], []).append(len(t))
        self.lengths = {k: sorted(set(v), reverse=True) for k, v in self.lengths.items()}
        self.fits: dict[tuple[bytes, bytes], bool] = {}

    def _merge(self, text: bytes) -> list[bytes]:
        """The merges in their order; only ever used on two tokens side by side."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 30))
            if parts[best] + parts[best + 1] not in self.ranks:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def live(self, last: list, window: bytes) -> set[int]:
        """Positions that the encoding of any longer text may run through: its end, and where a
        token across the end can start."""
        if self.prefixes is None:
            self.prefixes = {t[:n] for t in self.ranks for n in range(len(t))}
        return {i for i in range(max(0, len(window) - self.lookahead), len(window) + 1) if last[i] is not None and window[i:] in self.prefixes}

    def compatible(self, a: bytes, b: bytes) -> bool:
        """Whether tokens a and b can stand side by side in an encoding."""
        known = self.fits.get((a, b))
        if known is None:
            if len(self.fits) > 1 << 20:
                self.fits.clear()
            known = self.fits[a, b] = self._merge(a + b) == [a, b]
        return known

    def stream(self, chunks: Iterator[bytes]) -> Iterator[int]:
        """Ids of the concatenated chunks, given out once no later byte can change them."""
        ranks, lengths = self.ranks, self.lengths
        window = b""  # bytes from `base` on
        base = 0
        last: list[bytes | None] = [b""]  # last[i]: last token of the encoding up to base + i
        before = b""  # the token given out just before `base`
        for chunk in chunks:
            window += chunk
            for i in range(len(last), len(window) + 1):
                end = window[max(0, i - self.longest) : i]
                found = None
                for n in [*lengths.get(end[-2:], ()), *([] if len(end) == 1 else [1])] if i else ():
                    if n > i:
                        continue
                    t = window[i - n : i]
                    if t not in ranks:
                        continue
                    prev = last[i - n] if i > n else before
                    if prev is None:
                        continue
                    if not prev or self.compatible(prev, t):
                        found = t
                        break
                last.append(found)
            if len(window) > 8 * self.longest:
                live = self.live(last, window)
                while len(live) > 1:
                    far = max(live)
                    live.discard(far)
                    live.add(far - len(last[far]))
                stable = live.pop()
                if stable > 0:
                    yield from self._path(last, stable)
                    before = last[stable]
                    window, last = window[stable:], [before, *last[stable + 1 :]]
                    base += stable
        yield from self._path(last, len(last) - 1)

    def _path(self, last: list, end: int) -> list[int]:
        out = []
        while end > 0:
            out.append(self.ranks[last[end]])
            end -= len(last[end])
        return out[::-1]


class Encoder(dict):
    """Cache of short pieces; a missing piece goes through the transducer."""

    def __init__(self, ranks: dict[bytes, int]):
        import regex

        super().__init__()
        self.transducer = Transducer(ranks)
        self.split = regex.compile(PATTERN).findall
        self.ranks = ranks

    def __missing__(self, piece: str):
        raw = piece.encode("utf-8", "surrogatepass")
        whole = self.ranks.get(raw)
        if whole is not None:
            ids = (whole,)
        else:
            ids = tuple(self.transducer.stream(raw[i : i + 4096] for i in range(0, len(raw), 4096)))
        if len(piece) <= SHORT:
            if len(self) >= CACHED:
                self.clear()
            self[piece] = ids
        return ids

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The text's pieces, some thousand characters at a time.

        A text may be cut before white space that follows something else: no piece spans that.
        """
        at = 0
        while len(text) - at > PIECE:
            cut = at + PIECE
            while cut < len(text) and not (text[cut].isspace() and not text[cut - 1].isspace()):
                cut += 1
            yield self.split(text[at:cut])
            at = cut
        yield self.split(text[at:] if at else text)

    def encode_into(self, text: str, out: array) -> None:
        get = self.__getitem__
        for part in self.pieces(text):
            out.extend(chain.from_iterable(map(get, part)))

    def encode(self, text: str | None) -> list[int]:
        out = array("i")
        if text:
            self.encode_into(text, out)
        return out.tolist()


def _encode(ranks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks.value)
        for b in batches:
            flat, ends, start = array("i"), [0], 0
            for row, text in enumerate(b.column(1)):
                if (t := text.as_py()):
                    encoder.encode_into(t, flat)
                ends.append(len(flat))
                if len(flat) > 4_000_000 or row == b.num_rows - 1:
                    ids = pa.ListArray.from_arrays(
                        pa.array(ends, pa.int32()), pa.array(np.frombuffer(flat, np.int32) if len(flat) else np.zeros(0, np.int32))
                    )
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(start, row + 1 - start), ids], names=[b.schema.names[0], "ids"])
                    flat, ends, start = array("i"), [0], row + 1

    return run


def encode_corpus(df: DataFrame, key: str, text: str, vocabulary: str) -> DataFrame:
    """(key, ids) of every row; ``vocabulary`` is the path of the rank file.

    The ranks, a file of fixed size under a megabyte, are broadcast.
    """
    ranks = df.sparkSession.sparkContext.broadcast(load_ranks(vocabulary))
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("__key"), F.col(text).cast("string").alias("__text"))
    return spread(rows).mapInArrow(_encode(ranks), f"__key {kind}, ids array<int>").withColumnRenamed("__key", key)


class TextDecoder:
    """Ids to text, a token at a time: bytes of a character may come from several tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        self.bytes = {i: t for t, i in ranks.items()}

    def stream(self, ids) -> Iterator[str]:
        state = codecs.getincrementaldecoder("utf-8")("replace")
        for i in ids:
            yield state.decode(self.bytes.get(i, b""))
        yield state.decode(b"", True)

    def decode(self, ids) -> str:
        return "".join(self.stream(ids))


def _decode(ranks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = TextDecoder(ranks.value)
        for b in batches:
            flat, off = b.column(1).flatten().to_numpy(zero_copy_only=False), np.concatenate(
                ([0], np.cumsum(b.column(1).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))
            )
            texts = [decoder.decode(flat[off[i] : off[i + 1]].tolist()) for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=[b.schema.names[0], "text"])

    return run


def decode_corpus(df: DataFrame, key: str, ids: str, vocabulary: str) -> DataFrame:
    """(key, text) of every row of ids."""
    ranks = df.sparkSession.sparkContext.broadcast(load_ranks(vocabulary))
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("__key"), F.col(ids).alias("__ids"))
    return rows.mapInArrow(_decode(ranks), f"__key {kind}, text string").withColumnRenamed("__key", key)
