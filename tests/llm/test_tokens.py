"""Token files, BPE and token counts against the libraries themselves."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from frameloom.llm import bpe, subwords, token_counts, token_files

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_multi_50k.tiktoken")
PARTS = ["a", "the", " ", "  ", "\n", "\t", "\r", "é", "'s", "'", "ll", "9", "12", "!", "...", " ", "　", "\x1c", "\x85", "漢字", "_", "²", "<|endoftext|>", "\n\n", " \n", "-", "́", "😀", "Don't", "​", "T", "Ⅷ", "٣", "<|"]


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def ranked():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts(n):
    rng = random.Random(4)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_word_memo_gives_the_librarys_ids(plain, docs):
    enc = subwords.WordEncoder(JSON, words=50)  # generations turn over all the time
    texts = [r.text for r in docs.limit(60).collect()] + odd_texts(3000)
    assert enc.together > 1
    for at in (None, 1, 7):
        enc.together = at or enc.together
        for text, want in zip(texts, plain.encode_batch(texts, add_special_tokens=False), strict=True):
            assert np.frombuffer(enc.encode(text), enc.dtype).tolist() == want.ids, text
    assert enc.encode_all([*texts[:100], None, ""]) == [*map(enc.encode, texts[:100]), b"", b""]


@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=70))
@settings(max_examples=200, deadline=None)
def test_codes_round_trip(values):
    control, data = token_files.pack(np.array(values, dtype=np.uint32))
    assert token_files.unpack(control, data, len(values)).tolist() == values
    assert len(control) == -(-len(values) // 4) and len(data) == sum(max(1, -(-v.bit_length() // 8)) for v in values)


def expected(plain, rows):
    start = 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = plain.encode(text or "", add_special_tokens=False).ids + [0]
        yield doc, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()), ids
        start += len(ids)


@pytest.mark.parametrize("which", ["docs", "edge"])
def test_token_files(spark, plain, request, tmp_path, which):
    df = request.getfixturevalue(which)
    uri = f"file://{tmp_path}/shards"
    shards = token_files.write_token_files(spark, df, JSON, uri, shard_ids=5000)
    got = token_files.read_token_files(spark, uri, with_ids=True).collect()
    want = list(expected(plain, [(r.doc_id, r.text) for r in df.collect()]))
    assert Counter((r.doc_id, r.start, r.n_tokens, r.ids_crc32, tuple(r.ids)) for r in got) == Counter((*w[:4], tuple(w[4])) for w in want)
    assert sum(r.n_ids for r in shards.collect()) == sum(w[2] for w in want)
    assert [r.start for r in shards.orderBy("part", "seq").collect()] == sorted(r.start for r in shards.collect())
    # The most frequent id has the first rank.
    first = spark.read.parquet(f"{uri}/ranks").filter("rank = 0").first().id
    assert first == Counter(k for w in want for k in w[4]).most_common(1)[0][0]


def test_rows_of_one_id_spread(spark, plain, tmp_path):
    """Null ids and a repeated one do not go to one task, and keep their order."""
    rng = random.Random(3)
    rows = [(None if k % 3 else 7, f"{rng.random()} <|endoftext|> {k}") for k in range(300)]
    uri = f"file://{tmp_path}/shards"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        shards = token_files.write_token_files(spark, spark.createDataFrame(rows, "doc_id long, text string"), JSON, uri)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = token_files.read_token_files(spark, uri, with_ids=True).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32, r.ids) for r in got] == list(expected(plain, rows))
    assert shards.select("part").distinct().count() > 2 and 50256 in got[0].ids


def test_special_tokens_as_text():
    enc, library = subwords.WordEncoder(JSON, special_as_text=True), Tokenizer.from_file(JSON)
    library.encode_special_tokens = True
    text = "a <|endoftext|>b"
    assert np.frombuffer(enc.encode(text), enc.dtype).tolist() == library.encode(text).ids and 50256 not in library.encode(text).ids


def test_token_files_of_nothing(spark, none, tmp_path):
    uri = f"file://{tmp_path}/shards"
    assert token_files.write_token_files(spark, none, JSON, uri).count() == 0
    assert token_files.read_token_files(spark, uri).count() == 0
    with pytest.raises(ValueError, match="token file"):
        token_files.parse(b"something else")


@pytest.mark.parametrize("which", ["docs", "edge", "none"])
def test_round_trip(request, ranked, which):
    df = request.getfixturevalue(which)
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, r.exact) for r in bpe.round_trip(df, RANKS, P.PATTERN).collect())
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = Counter()
    for r in df.collect():
        ids = ranked.encode_ordinary(r.text or "")
        want[r.doc_id, len(ids), sha(",".join(map(str, ids)).encode()), sha((r.text or "").encode()), True] += 1
    assert got == want


def test_pieces_encode_apart(ranked):
    for text in odd_texts(3000):
        for size in (1, 7):
            parts = list(bpe.pieces(text, size))
            assert "".join(parts) == text and [k for p in parts for k in ranked.encode_ordinary(p)] == ranked.encode_ordinary(text), text
    assert max(map(len, bpe.pieces("ab cd" * 50_000))) < 2 * bpe.PIECE


def test_decode_takes_any_ids(spark, ranked):
    ids = ranked.encode_ordinary("漢字 and more")
    rows = spark.createDataFrame([(1, ids[:1]), (2, ids), (3, [])], "doc_id long, ids array<int>")
    assert [bytes(r.bytes) for r in bpe.decode(rows, RANKS, P.PATTERN).orderBy("doc_id").collect()] == [ranked.decode_bytes(ids[:1]), "漢字 and more".encode(), b""]
    again = bpe.encode(spark.createDataFrame([(2, "漢字 and more")], "doc_id long, text string"), RANKS, P.PATTERN)
    assert again.first().ids == ids


@pytest.mark.parametrize("which", ["docs", "edge", "none"])
def test_token_counts(spark, request, plain, which):
    df = request.getfixturevalue(which)
    lengths = [len(plain.encode(r.text or "", add_special_tokens=False).ids) for r in df.collect()]
    hist = token_counts.histogram(df, JSON).cache()
    assert {r.length: r.n_docs for r in hist.collect()} == Counter(lengths)
    rows = token_counts.limits(hist).collect()
    assert len(rows) == len(set(lengths))
    for r in rows:
        limit = r.context_limit
        assert r.docs_reaching == sum(n >= limit for n in lengths) and r.tokens_reaching == sum(n for n in lengths if n >= limit)
        assert (r.total_tokens, r.kept_tokens) == (sum(lengths), sum(min(n, limit) for n in lengths)) and r.lost_tokens == r.total_tokens - r.kept_tokens
        assert r.quantile == pytest.approx(sum(n <= limit for n in lengths) / len(lengths))
    at = {r.context_limit: (r.kept_tokens, r.docs_cut) for r in token_counts.totals_at(hist, [0, 5, 10**9]).collect()}
    assert at == {k: (sum(min(n, k) for n in lengths), sum(n > k for n in lengths)) for k in (0, 5, 10**9)}
    if lengths:
        got = {r.share: r.length for r in token_counts.quantiles(hist, [0.5, 0.99, 1.0]).collect()}
        assert got == {q: min(n for n in lengths if sum(m <= n for m in lengths) >= q * len(lengths) - 1e-9) for q in (0.5, 0.99, 1.0)}
