import random

import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from assaylake.llm import tokens as T

PATHS = T.VOCABULARIES


@pytest.fixture(scope="module", params=sorted(PATHS))
def pair(request):
    ranks = T.load_ranks(PATHS[request.param])
    return T.Encoder(ranks), tiktoken.Encoding("own", pat_str=T.PATTERN, mergeable_ranks=ranks, special_tokens={}), T.TextDecoder(ranks)


@settings(max_examples=200, deadline=None)
@given(text=st.text(max_size=200))
def test_any_text(pair, text):
    encoder, public, decoder = pair
    ids = encoder.encode(text)
    assert ids == public.encode_ordinary(text) and decoder.decode(ids) == text


@pytest.mark.parametrize("alphabet", ["ab", "abcdefghijklmnopqrstuvwxyz", "=", "-=", "é漢字🙂", "0123456789", " \n\t", "Aa the"])
def test_long_pieces_stream(pair, alphabet):
    encoder, public, _ = pair
    rng = random.Random(4)
    for n in (3, 127, 129, 3000, 40_000):
        text = "".join(rng.choice(alphabet) for _ in range(n))
        assert encoder.encode(text) == public.encode_ordinary(text)


def test_memory_of_the_transducer_is_bounded(pair):
    encoder, public, _ = pair
    rng = random.Random(9)
    text = "".join(rng.choice("abcdefgh") for _ in range(200_000))
    given_out, seen = [], 0

    def chunks():
        nonlocal seen
        for i in range(0, len(text), 1000):
            yield text[i : i + 1000].encode()
            seen = i + 1000

    out = 0
    for i in encoder.transducer.stream(chunks()):
        given_out.append(i)
        out += len(public.decode_single_token_bytes(i))
        assert seen + 1000 - out <= 8 * encoder.transducer.longest + 2000 or seen + 1000 >= len(text)
    assert given_out == public.encode_ordinary(text)


def test_special_strings_and_chunk_borders(pair):
    encoder, public, _ = pair
    for text in ["<|endoftext|>", "a<|endoftext|> b", "it's  we'll\r\n\tz ", ("word " * 40_000) + "  end", "x" * 70_000 + "\n\n y"]:
        assert encoder.encode(text) == public.encode_ordinary(text)


def test_corpus(spark):
    rows = [(1, ""), (2, None), (3, "hello  world"), (None, "x"), (3, "hello  world"), (5, "é" * 100_000)]
    df = spark.createDataFrame([(*r, "clash", 0) for r in rows], "doc_id long, body string, text string, ids int")
    path = PATHS["byte_bpe_50k"]
    got = T.encode_corpus(df, "doc_id", "body", path)
    public = tiktoken.Encoding("own", pat_str=T.PATTERN, mergeable_ranks=T.load_ranks(path), special_tokens={})
    assert sorted(((r.doc_id or 0), r.ids) for r in got.collect()) == sorted(((i or 0), public.encode_ordinary(t or "")) for i, t in rows)
    back = T.decode_corpus(got, "doc_id", "ids", path)
    assert sorted((r.doc_id or 0, r.text) for r in back.collect()) == sorted((i or 0, t or "") for i, t in rows)
    assert T.encode_corpus(df.limit(0), "doc_id", "body", path).count() == 0
    odd = spark.createDataFrame([(1, [1 << 29, 50255]), (2, None)], "doc_id long, ids array<int>")
    assert T.decode_corpus(odd, "doc_id", "ids", path).count() == 2


def test_no_later_byte_changes_what_is_given_out():
    """Small vocabularies, so that tokens overlap in many ways: every prefix's output stays a prefix."""
    rng = random.Random(2)
    for _ in range(30):
        tokens = [bytes([b]) for b in b"abc"]
        while len(tokens) < 14:
            t = rng.choice(tokens) + rng.choice(tokens)
            own = T.Transducer({x: i for i, x in enumerate([*tokens, t])})
            if t not in tokens and len(t) <= 9 and own._merge(t) == [t]:
                tokens.append(t)
        t = T.Transducer({x: i for i, x in enumerate(tokens)})
        text = bytes(rng.choice(b"abc") for _ in range(400))
        want = [t.ranks[x] for x in t._merge(text)]
        given, seen = [], 0

        def chunks():
            nonlocal seen
            for c in text:
                seen += 1
                yield bytes([c])

        late = 0
        for i in t.stream(chunks()):
            given.append(i)
            assert given == want[: len(given)]
            late = max(late, seen - sum(len(tokens[x]) for x in given))
        assert given == want and (late < 400 or len(want) < 5)
