"""Garbled text from wrong character encodings: find it and restore it where nothing was lost.

A noisy-channel decoder. The channel model is a list of (read as, written in) encodings. A token
of text is turned back into a lattice of the bytes it was read from, with a wildcard for every
byte that was lost to U+FFFD, and the lattice is decoded as it was written: one without
wildcards gives one text at most, one with wildcards every word of the corpus whose bytes fit.
The source model are the frequencies of words and characters over the whole corpus. A Viterbi
search through the tokens of a text picks the likeliest run of channels, the clean one being
free and every change into another one costing ``enter``.

Everything that depends on the corpus is counted and joined by Spark: distinct tokens, word
frequencies, candidate scores, and the words that fit a lattice with wildcards, which are joined
by their shape and one of the bytes that are known. Only candidates that could be on a best path
reach the texts.

Defined results: null and empty texts are never garbled; a text with characters lost to
U+FFFD inside words has an empty ``restored_md5`` (a guess fills ``guess`` where the corpus
knows a fitting word, the commonest, then the last in code point order); tokens that are right
stay untouched, whatever stands beside them; a U+FFFD that stands alone is text like any other;
a row without a key gives no row, as its text could not be named; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.session import cut, spread

# Fixed values: (read as, written in) of the channel model.
CHANNELS = [
    ("cp1252", "utf-8"),
    ("cp437", "utf-8"),
    ("cp850", "utf-8"),
    ("cp1250", "utf-8"),
    ("cp1251", "utf-8"),
    ("cp1254", "utf-8"),
    ("cp866", "utf-8"),
    ("koi8-r", "utf-8"),
    ("iso8859-15", "utf-8"),
    ("mac_roman", "utf-8"),
    ("mac_roman", "cp1252"),
    ("cp1252", "mac_roman"),
    ("cp437", "cp1252"),
    ("cp1252", "cp437"),
    ("cp850", "cp1252"),
    ("cp1252", "cp850"),
    ("cp1252", "cp1250"),
    ("cp1250", "cp1252"),
    ("cp1252", "iso8859-2"),
    ("cp1252", "cp1254"),
    ("cp1252", "cp1253"),
    ("cp1252", "cp1251"),
    ("cp1252", "koi8-r"),
    ("cp1252", "cp866"),
    ("koi8-r", "cp1251"),
    ("cp1251", "koi8-r"),
    ("cp1251", "cp866"),
    ("cp866", "cp1251"),
    ("cp1252", "gbk"),
    ("cp1252", "big5"),
    ("cp1252", "shift_jis"),
    ("cp1252", "euc_jp"),
    ("cp1252", "euc_kr"),
]
# Other encodings that UTF-8 is taken for, and other pairs of one script.
_SEEN = {("utf-8", "utf-8"), *CHANNELS}
_MULTIBYTE = ["gbk", "big5", "shift_jis", "euc_jp", "euc_kr"]
_WESTERN, _CYRILLIC = ["cp1252", "mac_roman", "cp437", "cp850"], ["cp1251", "koi8-r", "cp866"]
_OTHERS = ["cp1250", "iso8859-2", "cp1253", "cp1254", "cp1257", *_CYRILLIC]
CHANNELS += [
    c for c in [
        *((r, "utf-8") for r in ["iso8859-2", "cp1253", "cp1255", "cp1256", "cp1257", *_MULTIBYTE]),
        *((r, w) for group in (_WESTERN, _CYRILLIC) for r in group for w in group if r != w),
        *((r, w) for r in ("cp1252", "cp437") for w in _OTHERS)
    ] if c not in _SEEN
]
CLEAN, WILDCARD = -1, -2
LOST = "�"
TOKEN = re.compile(r"[^ \t\r\n]+")
_EAST = "⺀-鿿가-힯豈-﫿＀-￯"
EAST = re.compile(f"[{_EAST}]")
UNIT = re.compile(rf"[{_EAST}]|[^\W\d_{_EAST}]+|[^\x00-\x7f]")
_FORBIDDEN = re.compile("[\x00-\x08\x0e-\x1f\x7f-\x9f-�￰-￿]")
_LATIN, _OTHER = re.compile("[A-Za-zÀ-ɏ]"), re.compile("[Ͱ-ϿЀ-ӿ]")
# a unit that tells something: two letters or more with one beyond ASCII, an East Asian
# character, or a whole token of three characters with a letter
_TELLING = r"(?s)^w(?=\p{L}{2})(?=.*[^\x00-\x7F])|^e|^t(?=.{3})(?=.*\p{L})"
_TABLES: dict[str, dict[str, int]] = {}


def table(encoding: str) -> dict[str, int]:
    """Character to byte; bytes that the encoding lacks are read as control characters."""
    if encoding not in _TABLES:
        own = {}
        for b in range(256):
            own[chr(b) if b < 128 else bytes([b]).decode(encoding, "ignore") or chr(b)] = b
        _TABLES[encoding] = {chr(b): b for b in range(256)} | own if encoding == "cp1252" else own
    return _TABLES[encoding]


def lattice(text: str, read_as: str) -> list[int] | None:
    """The bytes that a text was read from, -1 for a lost one; None if it can't have been read so."""
    out: list[int] = []
    if read_as in _MULTIBYTE or read_as == "utf-8":
        for i, part in enumerate(text.split(LOST)):
            try:
                out += ([-1] if i else []) + list(part.encode(read_as))
            except UnicodeEncodeError:
                return None
        return out
    known = table(read_as)
    for c in text:
        b = -1 if c == LOST else known.get(c)
        if b is None:
            return None
        out.append(b)
    return out


def decode(bytes_of: list[int] | None, written_in: str) -> str | None:
    """The text of a lattice without wildcards; None if there is none."""
    try:
        return bytes(bytes_of).decode(written_in) if bytes_of is not None and -1 not in bytes_of else None
    except UnicodeDecodeError:
        return None


def reread(text: str, read_as: str, written_in: str) -> str | None:
    """What ``text`` was before, or None if it can't have come this way."""
    back = decode(lattice(text, read_as), written_in)
    return back if back != text else None


def unchanged(text: str, channel: int) -> bool:
    """Whether the text comes through the channel as it is."""
    return 0 <= channel < len(CHANNELS) and decode(lattice(text, CHANNELS[channel][0]), CHANNELS[channel][1]) == text


def plausible(text: str) -> bool:
    """No control characters, and no word of two scripts."""
    if _FORBIDDEN.search(text):
        return False
    return not any(_LATIN.search(w) and _OTHER.search(w) for w in UNIT.findall(text))


def candidates(token: str) -> dict[str, list[int]]:
    """Texts that the token may have been, with the channels that give them.

    The number of a channel read twice in a row is that of the channel plus len(CHANNELS).
    """
    out: dict[str, list[int]] = {}
    for i, (read_as, written_in) in enumerate(CHANNELS):
        back = reread(token, read_as, written_in)
        if back is None and written_in == "utf-8":  # a token that is garbled in part
            back = re.sub(r"[^\x00-\x7f]{2,}", lambda m: reread(m[0], read_as, written_in) or m[0], token)
            back = back if back != token else None
        if back is None:
            continue
        if plausible(back):
            out.setdefault(back, []).append(i)
        if written_in == "utf-8" and (twice := reread(back, read_as, written_in)) and plausible(twice):
            out.setdefault(twice, []).append(i + len(CHANNELS))
    return out


def units(text: str) -> list[str]:
    """Words (w), East Asian characters (e), words of two scripts (m) and the token itself (t)."""
    kinds = []
    for u in UNIT.findall(text):
        kinds.append(("e" if EAST.match(u) else "m" if _LATIN.search(u) and _OTHER.search(u) else "w") + u)
    return [*kinds, "t" + text]


def shape(bytes_of: list[int]) -> str:
    """The ASCII bytes of a lattice as they are, every other byte, known or lost, as one U+FFFD."""
    return "".join(chr(b) if 0 <= b < 128 else LOST for b in bytes_of)


def skeleton(token: str) -> str:
    """The token with each character beyond ASCII as so many lost bytes."""
    return re.sub(r"[^\x00-\x7f]", lambda m: LOST if m[0] == LOST else LOST * len(m[0].encode("utf-8", "surrogatepass")), token)


def lost(token: str) -> bool:
    """Whether bytes are lost in the token: several in a row, or inside a word."""
    return bool(re.search(f"{LOST}{LOST}|\\w{LOST}|{LOST}\\w", token))


def fits(token: str, word: str) -> bool:
    """Whether the word can be the token before bytes of its UTF-8 were lost."""
    own, held = lattice(token, "utf-8"), list(word.encode("utf-8", "surrogatepass"))
    # a character is lost as a whole or not at all
    return len(own) == len(held) and all(x in (-1, y) for x, y in zip(own, held)) and skeleton(token) == skeleton(word)


def _distinct_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows, toks, times = [], [], []
        for i, t in enumerate(b.column(1).to_pylist()):
            if t and not t.isascii():
                own = Counter(x for x in TOKEN.findall(t) if not x.isascii())
                rows.extend([i] * len(own))
                toks.extend(own)
                times.extend(own.values())
        yield pa.RecordBatch.from_arrays(
            [b.column(0).take(pa.array(rows, pa.int64())), pa.array(toks, pa.string()), pa.array(times, pa.int64())],
            names=["digest", "token", "times"]
        )


def _units_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out: dict[str, int] = {}
        for t, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            for u in units(t):
                out[u] = out.get(u, 0) + n
        yield pa.RecordBatch.from_arrays([pa.array(out.keys(), pa.string()), pa.array(out.values(), pa.int64())], names=["unit", "n"])


def _candidates_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for t in b.column(0).to_pylist():
            found = candidates(t)
            if found:
                rows.append((t, t, [CLEAN], units(t)))
                rows += [(t, back, ch, units(back)) for back, ch in found.items()]
        cols = list(zip(*rows)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(cols[0], pa.string()),
                pa.array(cols[1], pa.string()),
                pa.array(cols[2], pa.list_(pa.int32())),
                pa.array(cols[3], pa.list_(pa.string()))
            ],
            names=["token", "text", "channels", "units"]
        )


def _lattices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lattices with wildcards of damaged tokens, for UTF-8 that lost bytes itself or was misread besides."""
    ways = ["utf-8", *dict.fromkeys(r for r, w in CHANNELS if w == "utf-8")]
    for b in batches:
        rows = []
        for t in b.column(0).to_pylist():
            for way in ways:
                own = lattice(t, way)
                if own is None or -1 not in own or (way != "utf-8" and all(x < 128 for x in own)):
                    continue  # nothing beyond ASCII but the gaps: the way makes no difference
                at = next((i for i, x in enumerate(own) if x > 127), -1)
                rows.append((t, own, shape(own), at, own[at] if at >= 0 else -1))
        cols = list(zip(*rows)) or [[]] * 5
        kinds = [pa.string(), pa.list_(pa.int32()), pa.string(), pa.int32(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["token", "lattice", "shape", "at", "byte"])


def _lost_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield b.filter(pa.array([lost(t) for t in b.column(0).to_pylist()], pa.bool_())).select(["token"])


def _word_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        raw = [t.encode("utf-8", "surrogatepass") for t in b.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*b.columns, pa.array([shape(r) for r in raw], pa.string()), pa.array([list(r) for r in raw], pa.list_(pa.int32()))],
            names=[*b.schema.names, "shape", "bytes"]
        )


def fill_wildcards(tokens: DataFrame) -> DataFrame:
    """(token, word, n): the commonest word of the corpus that fits a lattice of each damaged token.

    tokens: token and n. Lattices and words are joined by their shape and the first byte beyond
    ASCII that is known; where none is, the commonest word of the shape fits.
    """
    damaged = tokens.where(F.col("token").contains(LOST)).select("token")
    lattices = cut(damaged.mapInArrow(_lattices, "token string, lattice array<int>, shape string, at int, byte int"))
    words = tokens.where(~F.col("token").contains(LOST)).mapInArrow(_word_bytes, "token string, n bigint, shape string, bytes array<int>")
    words = cut(words.withColumnRenamed("token", "word").join(lattices.select("shape").distinct(), "shape", "left_semi"))
    each = words.select("*", F.posexplode("bytes").alias("at", "byte")).where("byte > 127")
    fit = lattices.where("at >= 0").join(each, ["shape", "at", "byte"]).where(
        F.forall(F.zip_with("lattice", "bytes", lambda x, y: (x == -1) | (x == y)), lambda ok: ok)
    )
    best = lambda: F.max_by(F.struct("word", "n"), F.struct("n", "word")).alias("w")
    common = words.groupBy("shape").agg(best())
    bare = lattices.where("at < 0").join(common, "shape").select("token", "w.word", "w.n")
    found = fit.select("token", "word", "n").unionByName(bare)
    return found.groupBy("token").agg(best()).select("token", "w.word", "w.n")


def decode_path(tokens: list[str], known: dict[str, list[tuple[list[int], str, float]]], enter: float) -> list[tuple[int, str]]:
    """Viterbi: the likeliest channel of each token, and the token's text in it."""
    score, back = {CLEAN: 0.0}, []
    for t in tokens:
        here: dict[int, tuple[float, str]] = {CLEAN: (0.0, t)}
        if t.isascii():
            here.update({c: (0.0, t) for c in score})
        else:
            for channels, text, gain in known.get(t, ()):
                here.update({c: (gain, text) for c in channels if c not in here or here[c][0] < gain})
            here.update({c: (0.0, t) for c in score if c not in here and unchanged(t, c)})
        best, best_score = max(score.items(), key=lambda x: (x[1], x[0] == CLEAN))
        nxt, step = {}, {}
        for c, (gain, text) in here.items():
            came, s = (best, best_score - (0.0 if c == CLEAN else enter))
            if c in score and score[c] >= s:
                came, s = c, score[c]
            nxt[c], step[c] = s + gain, (came, text)
        score = nxt
        back.append(step)
    at = max(score.items(), key=lambda x: (x[1], x[0] == CLEAN))[0]
    out = []
    for step in reversed(back):
        came, text = step[at]
        out.append((at, text))
        at = came
    return out[::-1]


def _restore(enter: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for i, (text, known) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist())):
                by = {x["token"]: [(c["channels"], c["text"], c["gain"]) for c in x["cands"] or ()] for x in known}
                places = [m for m in TOKEN.finditer(text)]
                path = decode_path([m[0] for m in places], by, enter)
                if not any(c != CLEAN and new != m[0] for m, (c, new) in zip(places, path)) and not any(lost(t) for t in by):
                    continue
                parts, at = [], 0
                for m, (_, new) in zip(places, path):
                    parts += [text[at : m.start()], new]
                    at = m.end()
                whole = "".join([*parts, text[at:]])
                gone = any(lost(m[0]) for m in places)
                named = sorted({c for m, (c, new) in zip(places, path) if c >= 0 and new != m[0]})
                names = [
                    f"{CHANNELS[c % len(CHANNELS)][1]} read as {CHANNELS[c % len(CHANNELS)][0]}" + " twice" * (
                        c >= len(CHANNELS)
                    ) for c in named
                ]
                found.append((i, None if gone else whole, "" if gone else hashlib.md5(whole.encode()).hexdigest(), names, whole if gone else None))
            cols = list(zip(*found)) or [[]] * 5
            kinds = [pa.string(), pa.string(), pa.list_(pa.string()), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(cols[0], pa.int64())), *[pa.array(c, k) for c, k in zip(cols[1:], kinds)]],
                names=["digest", "restored", "restored_md5", "channels", "guess"]
            )

    return run


def restore_garbled(df: DataFrame, key: str, text: str, enter: float = 4.0, east_weight: float = 0.6) -> DataFrame:
    """(key, restored, restored_md5, channels, guess) of every row with garbled text.

    ``enter`` is the cost, in nats, of passing into another channel; ``east_weight`` the share
    of an East Asian character's surprise that its neighbours leave.
    """
    docs = df.select(F.col(key).alias("key"), F.col(text).alias("text")).where(F.col("text").rlike(r"[^\x00-\x7F]"))
    docs = docs.withColumn("digest", F.sha2("text", 256))
    # copies of a text tell nothing new about words: each distinct text is counted and restored once
    once = cut(spread(docs).groupBy("digest").agg(F.first("text").alias("text")))
    words = cut(once.mapInArrow(_distinct_tokens, "digest string, token string, times bigint"))
    tokens = cut(words.groupBy("token").agg(F.count("*").alias("n")))
    freq = cut(tokens.mapInArrow(_units_of, "unit string, n bigint").groupBy("unit").agg(F.sum("n").alias("n")))
    total = float(freq.agg(F.sum("n")).first()[0] or 1)
    # score of each candidate: its units' frequencies over the corpus, unknown ones by length
    cands = tokens.select("token").mapInArrow(_candidates_of, "token string, text string, channels array<int>, units array<string>")
    each = cands.select("token", "text", "channels", F.explode("units").alias("unit")).join(freq, "unit", "left")
    kind_of, seen = F.substring("unit", 1, 1), F.log(F.col("n") / total)
    unseen = F.lit(math.log(0.5 / total)) - 2.5 * (F.length("unit") - 2)
    # neighbours predict much of an East Asian character; a word of two scripts is no word
    part = F.when(kind_of == "m", unseen).when((kind_of == "e") & F.col("n").isNotNull(), east_weight * seen).otherwise(
        F.coalesce(F.greatest(seen, unseen), unseen)
    )
    scored = each.groupBy("token", "text", "channels").agg(
        F.sum(F.when(kind_of != "t", part)).alias("parts"),
        F.max(F.when(kind_of == "t", seen)).alias("whole"),
        F.max(F.col("n").isNotNull() & F.col("unit").rlike(_TELLING)).alias("met")
    )
    # single bytes can be read as anything: only a word that the corpus knows is evidence for
    # such a reading, while bytes that are well-formed UTF-8 speak for themselves
    multibyte = [i for i, (_, w) in enumerate(CHANNELS) if w == "utf-8"]
    scored = scored.withColumn("utf8", F.exists("channels", lambda c: c.isin(*multibyte) | (c >= len(CHANNELS))))
    # if such a reading is a known word, that decides however common the garbled form is; more joined bytes are surer
    telling = F.col("whole").isNotNull() & F.concat(F.lit("t"), "text").rlike(_TELLING)
    floor = F.when(F.col("utf8") & telling, enter + F.length("token") - F.length("text"))
    scored = scored.withColumns({"met": F.col("met") | F.col("utf8"), "floor": floor})
    pick = lambda c: F.first(F.when(F.col("text") == F.col("token"), F.col(c)), True)
    alts = F.collect_list(F.when(F.col("text") != F.col("token"), F.struct("channels", "text", "parts", "whole", "met", "floor")))
    suspects = scored.groupBy("token").agg(pick("parts").alias("parts"), pick("whole").alias("whole"), alts.alias("alts"))
    # if the corpus knows both as whole tokens, that decides, unless their parts say so more clearly

    def gain(a):
        by_parts, by_whole = a["parts"] - F.col("parts"), a["whole"] - F.col("whole")
        both = F.when(by_whole > 0, F.greatest(by_parts, by_whole)).otherwise(F.coalesce(by_whole, by_parts))
        both = F.when(a["floor"].isNotNull(), F.greatest(by_parts, by_whole, a["floor"])).otherwise(both)
        return F.when(a["met"], both).otherwise(F.least(both, F.lit(0.0)))

    # a candidate that loses more than a change of channel costs can't be on a best path
    gained = F.filter(
        F.transform("alts", lambda a: F.struct(a["channels"].alias("channels"), a["text"].alias("text"), gain(a).alias("gain"))),
        lambda a: a["gain"] > -enter
    )
    suspects = suspects.select("token", gained.alias("cands")).where(F.size("cands") > 0)
    # lost bytes: what fits the lattice, or the token as it is, so that its text is named
    whole = tokens.where(F.col("token").contains(LOST)).mapInArrow(_lost_tokens, "token string")
    holes = whole.join(fill_wildcards(tokens), "token", "left").select(
        "token",
        F.array(
            F.struct(F.array(F.lit(WILDCARD)).alias("channels"), F.coalesce("word", "token").alias("text"), F.lit(2 * enter).alias("gain"))
        ).alias("cands")
    )
    known = cut(suspects.unionByName(holes))
    best = F.greatest(F.lit(0.0), F.array_max(F.transform("cands", lambda c: c["gain"])))
    hit = words.join(known, "token").groupBy("digest").agg(
        F.collect_list(F.struct("token", "cands")).alias("known"),
        F.sum(best * F.col("times")).alias("most"),
        F.max(F.col("token").contains(LOST)).alias("holes")
    )
    hit = hit.where((F.col("most") > enter) | F.col("holes")).select("digest", "known")
    shape = "digest string, restored string, restored_md5 string, channels array<string>, guess string"
    found = once.join(hit, "digest").select("digest", "text", "known").mapInArrow(_restore(enter), shape)
    rows = docs.where(F.col("key").isNotNull()).select("key", "digest")
    return rows.join(found, "digest").drop("digest").withColumnRenamed("key", key)
