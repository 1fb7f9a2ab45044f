"""Near-duplicate documents and vectors, and the pipeline, against all pairs."""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from frameloom.llm import common, embed_dedup, lang_id, minhash, queries


def test_components(spark):
    rng = np.random.default_rng(3)
    for pairs in ([], [(5, 5)], [(k, k + 1) for k in range(60)], [(0, k) for k in range(1, 90)], rng.integers(0, 200, (150, 2)).tolist()):
        edges = spark.createDataFrame([(int(a), int(b)) for a, b in pairs], "a long, b long")
        got = {r.node: r.comp for r in common.components(edges, common.Scratch(spark, "cc"), "t").collect()}
        up = {}

        def root(x, up=up):
            while up.setdefault(x, x) != x:
                x = up[x]
            return x

        for a, b in pairs:
            a, b = sorted((root(a), root(b)))
            up[b] = a
        assert got == {x: root(x) for a, b in pairs if a != b for x in (a, b)}


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    sets, true = [], []
    for _ in range(150):
        a = np.unique(rng.integers(0, 2**63, int(rng.integers(2, 3000))).astype(np.uint64))
        b = np.unique(np.concatenate([a[: int(len(a) * rng.uniform(0.5, 1)) + 1], rng.integers(0, 2**63, int(len(a) * 0.2)).astype(np.uint64)]))
        sets += [a, b]
        true.append(len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
    sig = minhash.signatures(sets)
    got = (sig[::2] == sig[1::2]).mean(axis=1)
    assert abs((got - true).mean()) < 0.01 and np.abs(got - true).max() < 0.2
    together, apart = sig[:6], np.concatenate([minhash.signatures([s]) for s in sets[:6]])
    assert (together == apart).all()  # a signature depends on its own set only


def test_weighted_signatures():
    rng = np.random.default_rng(2)
    sets = [rng.integers(0, 2**63, 40).astype(np.uint64) for _ in range(200)]
    a = [rng.random(40) * 4 + 0.01 for _ in sets]
    b = [w * np.where(rng.random(40) < 0.5, 1, 0.4) for w in a]
    sig = minhash.signatures([s for s in sets for _ in "ab"], [w for pair in zip(a, b, strict=True) for w in pair])
    true = [np.minimum(x, y).sum() / np.maximum(x, y).sum() for x, y in zip(a, b, strict=True)]
    assert abs((sig[::2] == sig[1::2]).mean() - np.mean(true)) < 0.01


def test_overlaps():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 300, n).astype(np.uint64)) for n in (5, 100, 200, 1, 60)]
    assert minhash.overlaps(sets).diagonal().tolist()[1:3] != [0, 0]
    got = minhash.overlaps(sets)
    for i in range(5):
        for j in range(i):
            assert got[i, j] == len(np.intersect1d(sets[i], sets[j]))


def brute_classes(rows, threshold=0.8):
    """Smallest document reachable by links, by all pairs of rows; rows of one
    id are in one class."""
    sets = []
    for doc, text in rows:
        words = (text or "").split()
        n = min(5, len(words))
        if words:
            sets.append((doc, {tuple(words[k : k + n]) for k in range(len(words) - n + 1)}))
    up = {doc: doc for doc, _ in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (d, a) in enumerate(sets):
        for e, b in sets[:i]:
            if min(len(a), len(b)) >= threshold * max(len(a), len(b)) and len(a & b) >= threshold * len(a | b) - 1e-9:
                x, y = sorted((root(d), root(e)))
                up[y] = x
    return {doc: root(doc) for doc, _ in rows}


def edited(rng, words, share):
    return " ".join(w if rng.random() > share else f"new{rng.integers(1 << 30)}" for w in words)


def test_near_duplicates_of_planted_groups(spark, monkeypatch):
    """Groups of copies and near copies larger than a block, over a text
    passage that all documents share."""
    monkeypatch.setattr(minhash, "BUCKET_BLOCK", 16)
    monkeypatch.setattr(minhash, "SET_BLOCK", 8)
    rng = np.random.default_rng(6)
    shared = [f"s{k}" for k in range(40)]
    base = [f"b{k}" for k in range(200)]
    rows = [(k, edited(rng, base, rng.uniform(0, 0.03)) + " " + " ".join(shared)) for k in range(70)]
    rows += [(100 + k, " ".join([f"u{k}x{j}" for j in range(120)] + shared)) for k in range(60)]
    rows += [(200 + k, "exactly the same text of some more than five words") for k in range(50)]
    rows += [(300 + k, " ".join(f"p{k // 2}x{j}" for j in range(100))) for k in range(20)]
    got = {r["doc"]: r.class_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    assert got == brute_classes(rows)
    assert len(set(got.values())) < 150


def test_near_duplicates_of_documents(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for weighting in ("distinct", "count"):
        got = {r["doc"]: r.class_id for r in minhash.near_duplicates(docs, weighting=weighting).collect()}
        assert got == brute_classes(rows)


def test_rows_that_share_an_id(spark):
    """Different texts of one id, null or not, and many rows that are the same."""
    rng = np.random.default_rng(14)
    base = [[f"b{t}x{k}" for k in range(60)] for t in range(12)]
    rows = [(int(rng.integers(0, 40)), edited(rng, base[rng.integers(0, 12)], rng.choice([0, 0, 0.02]))) for _ in range(90)]
    rows += [(50, " ".join(base[0]))] * 300 + [(51, "other words than those of all the others")]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    want = brute_classes(list(dict.fromkeys(rows)))
    first = {}
    for doc, text in rows:
        first[text] = min(doc, first.get(text, doc))
    assert Counter((r["doc"], r.copy_of, r.class_id) for r in got) == Counter((d, first[t], want[d]) for d, t in rows)
    assert len(set(want.values())) > 1
    some = [(None, " ".join(base[1])), (None, " ".join(base[2])), (4, " ".join(base[2])), (5, " ".join(base[3])), (4, " ".join(base[3]))]
    got = {(r["doc"], r.copy_of, r.class_id) for r in minhash.near_duplicates(spark.createDataFrame(some, "doc_id long, text string")).collect()}
    null = common.NULL_ID
    assert got == {(null, null, null), (4, null, null), (4, 4, null), (5, 4, null)}


def test_near_duplicate_edges(edge, none):
    got = minhash.near_duplicates(edge).collect()
    rows = [(common.NULL_ID if r.doc_id is None else r.doc_id, r.text) for r in edge.collect()]
    assert Counter(r["doc"] for r in got) == Counter(d for d, _ in rows)
    of = {r["doc"]: r.class_id for r in got if r["doc"] != common.NULL_ID}
    assert of[5] == 4 and of[0] == 0 and of[1] == 1 and of[2] == 2
    assert minhash.near_duplicates(none).count() == 0
    with pytest.raises(ValueError, match="weighting"):
        minhash.near_duplicates(none, weighting="other")


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, rep string, n int")


def brute_links(rows, threshold=0.95):
    units = [embed_dedup.unit(v) for _, v in rows]
    up = {k: k for k, _ in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    links = [0] * len(rows)
    for i, a in enumerate(units):
        for j in range(i):
            b = units[j]
            if a is not None and b is not None and len(a) == len(b) and a @ b >= threshold:
                links[i] += 1
                links[j] += 1
                x, y = sorted((root(rows[i][0]), root(rows[j][0])))
                up[y] = x
    return Counter((k, n, root(k)) for (k, _), n in zip(rows, links, strict=True))


def test_embedding_links(spark, monkeypatch):
    """Every vector is indexed and all links are found, though cells are small
    and blocks smaller."""
    monkeypatch.setattr(embed_dedup, "BLOCK", 16)
    monkeypatch.setattr(embed_dedup, "VISITORS", 32)
    rng = np.random.default_rng(8)
    base = rng.standard_normal((40, 16))
    near = base[rng.integers(0, 8, 160)] + 0.12 * rng.standard_normal((160, 16))
    same = np.repeat(base[:1], 60, axis=0)
    rows = [(int(k), v.astype(np.float32).tolist()) for k, v in zip(rng.permutation(260), np.concatenate([base, near, same]), strict=True)]
    want = brute_links(rows)
    got = Counter((r.vec, r.n_links, r.component) for r in embed_dedup.embedding_links(vectors(spark, [(*r, 1, "clash", 0) for r in rows]), cell_rows=8).collect())
    assert sum((got & want).values()) >= 0.9 * len(rows)
    found, there = (sum(n * c for (_, n, _), c in x.items()) for x in (got, want))
    assert 0.98 * there <= found <= there


def test_embedding_edges(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(0, v), (1, [2.0, 4.0, 6.0]), (2, None), (3, []), (4, [0.0, 0.0, 0.0]), (5, [1.0, None, 1.0]), (6, [float("nan"), 1.0, 1.0]), (7, [1.0, 2.0]), (8, [float("inf"), 0.0, 0.0]), (9, v), (10, [-1.0, -2.0, -3.0])]
    got = {r.vec: (r.n_links, r.component) for r in embed_dedup.embedding_links(vectors(spark, [(*r, None, None, None) for r in rows])).collect()}
    assert got == {0: (2, 0), 1: (2, 0), 9: (2, 0)} | {k: (0, k) for k in (2, 3, 4, 5, 6, 7, 8, 10)}
    assert embed_dedup.embedding_links(vectors(spark, [])).count() == 0
    repeated = embed_dedup.embedding_links(vectors(spark, [(1, v, 0, "", 0)] * 2 + [(None, v, 0, "", 0)])).collect()
    assert Counter((r.n_links, r.component) for r in repeated) == {(2, common.NULL_ID): 3}


def test_embedding_ids_null_or_repeated(spark):
    """An id, null or not, that stands on rows of different vectors."""
    a, b = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(None, a), (None, b), (5, b), (6, [1.0, 0.1, 0.0]), (7, [0.0, 1.0, 0.1])]
    got = Counter((r.vec, r.n_links, r.component) for r in embed_dedup.embedding_links(vectors(spark, [(*r, 0, "", 0) for r in rows])).collect())
    null = common.NULL_ID
    assert got == Counter([(null, 1, null), (null, 2, null), (5, 2, null), (6, 1, null), (7, 2, null)])
    rng = np.random.default_rng(10)
    base = rng.standard_normal((30, 12))
    some = base[rng.integers(0, 30, 150)] + np.where(rng.random((150, 1)) < 0.5, 0.05, 0) * rng.standard_normal((150, 12))
    for first, ids in ((null, np.r_[[null] * 90, range(60)]), (0, rng.integers(0, 130, 150))):
        rows = [(int(k), v.astype(np.float32).tolist()) for k, v in zip(ids, some, strict=True)] + [(int(ids[-1]), None)]
        shown = [(None if k == null else k, v, 0, "", 0) for k, v in rows]
        got = Counter((r.vec, r.n_links, r.component) for r in embed_dedup.embedding_links(vectors(spark, shown)).collect())
        assert got == brute_links(rows) and min(c for _, _, c in got) >= first


def test_embedding_lengths(spark):
    """Vectors of every length are compared with those of that length, in one
    cell (12 lengths of few vectors) or several (two lengths)."""
    rng = np.random.default_rng(11)
    rows = []
    for dim, size in [(16, 90), (10, 60), *((k, 3) for k in range(20, 32)), (1, 2)]:
        base = rng.standard_normal((5, dim))
        rows += [v.astype(np.float32).tolist() for v in base[rng.integers(0, 5, size)] + np.where(rng.random((size, 1)) < 0.5, 0.02, 0) * rng.standard_normal((size, dim))]
    rows = [(int(k), rows[k]) for k in rng.permutation(len(rows))] + [(900, None), (901, [])]
    got = Counter((r.vec, r.n_links, r.component) for r in embed_dedup.embedding_links(vectors(spark, [(*r, 0, "", 0) for r in rows]), cell_rows=8).collect())
    assert got == brute_links(rows)
    assert {len(v) for k, v in rows[:-2] if any(x == k and n for x, n, _ in got)} >= {10, 16}


def test_traversal_is_in_order():
    rng = np.random.default_rng(9)
    for m, k1, k2, reach in ((1, 7, 5, 0.4), (30, 7, 5, 0.3), (8, 1, 9, 0.5), (5, 6, 6, 9.0), (4, 3, 3, 0.0)):
        d1, d2 = rng.random((m, k1)), rng.random((m, k2))
        sums = (d1[:, :, None] + d2[:, None]).reshape(m, -1)
        rows, cells = embed_dedup.traverse(d1, d2, reach)
        for r in range(m):
            own = cells[rows == r]
            assert set(own.tolist()) == set(np.flatnonzero(sums[r] - sums[r].min() <= reach + 1e-15).tolist())
            assert own[0] == sums[r].argmin() and (np.diff(sums[r][own]) >= 0).all()
        assert (np.diff(rows) >= 0).all()
    assert len(embed_dedup.traverse(rng.random((3, 4)), rng.random((3, 5)), 99.0)[0]) == 60


def test_units_of_a_column_are_those_of_each():
    import pyarrow as pa

    rows = [[1.0, 2.0], None, [], [0.0, 0.0], [3.0], [1e300, 1e300, 1.0], [1e-320, 0.0], [None, 1.0], [float("nan"), 1.0], [float("-inf"), 1.0], [-1.0, 5.0], [2.0, 4.0]]
    got = embed_dedup.units(pa.array(rows, pa.list_(pa.float64())))
    for row, v in zip(rows, got, strict=True):
        want = embed_dedup.unit(row)
        assert (v is None) == (want is None) and (v is None or np.allclose(v, want, rtol=1e-15, atol=0))
    assert (got[0] == got[11]).all()


def test_recall_and_rows_dealt(spark):
    """The vectors of sf0.1 with copies at just the threshold: in more than
    100 cells, at the production settings."""
    base = np.array([r[0] for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").select("embedding").collect()], dtype=np.float64)
    rng = np.random.default_rng(12)
    some = base[rng.permutation(len(base))[:600]]
    some /= np.linalg.norm(some, axis=1)[:, None]
    noise = rng.standard_normal(some.shape)
    noise[::3, :32] = 0  # a third of the copies differ in one half only
    noise -= (noise * some).sum(1)[:, None] * some
    near = 0.9502 * some + np.sqrt(1 - 0.9502**2) * noise / np.linalg.norm(noise, axis=1)[:, None]
    rows = [(k, v.tolist()) for k, v in enumerate(np.concatenate([base, near]))]
    df = spark.createDataFrame([(*r, 0, "", 0) for r in rows], "vec_id long, embedding array<double>, label int, rep string, n int")
    want = brute_links(rows)
    got = Counter((r.vec, r.n_links, r.component) for r in embed_dedup.embedding_links(df).collect())
    found, there = (sum(n * c for (_, n, _), c in x.items()) for x in (got, want))
    x = base / np.linalg.norm(base, axis=1)[:, None]
    index = embed_dedup.MultiIndex(x, round((len(rows) / embed_dedup.CELL_ROWS) ** 0.5), 0.95, embed_dedup.TARGET_RECALL)
    visited = len(index.visits(x)[0]) / len(x)
    print(f"recall {found / there:.4f} of {there} links' ends, {index.cells} cells, {visited:.2f} visited by a vector")
    assert there >= 1200 and found >= 0.99 * there and index.cells > 100 and 1 + visited < 8


def test_pipeline(spark, tmp_path):
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    key = lambda line: line.strip(" \t\n\v\f\r").encode().lower()
    with_letters = [r for r in docs if r.text and any(map(str.isalpha, r.text))]
    held = defaultdict(set)
    for r in with_letters:
        for line in r.text.split("\n"):
            held[key(line)].add(r.doc_id)
    gone = lambda d, line: len(line.strip(" \t\n\v\f\r")) >= 20 and len(held[key(line)]) >= 3 and max(held[key(line)]) != d
    texts = [(r.doc_id, "\n".join(x for x in r.text.split("\n") if not gone(r.doc_id, x))) for r in with_letters]
    kept = {d for d, c in brute_classes(texts).items() if d == c}
    assert set(got) == kept
    import public_tokenizers as P

    from frameloom.llm import bpe

    enc = bpe.encoder(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    assert all(got[d].ids == enc.encoding.encode_ordinary(t) and got[d].exact for d, t in texts if d in kept)


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_takes_edges(spark, edge, tmp_path, empty):
    """Each stage, and run, on rows with nulls, ties and repeats, with columns
    of names that operators use themselves."""
    df = edge.limit(0) if empty else edge
    names = ["base", "slots", "fl_doc", "fl_row", "fl_text", "fl_lang", "fl_gone", "fl_kept", "fl_position", "fl_source", "node", "rep"]
    df = df.withColumns({c: F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for c in names})
    said = {(r.doc_id, *(r[c] for c in names)) for r in df.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, "/root/testdata/sf0.001")
        assert out.columns == df.columns and {f.name: f.dataType for f in out.schema} == {f.name: f.dataType for f in df.schema}
        rows = out.collect()
        assert {(r.doc_id, *(r[c] for c in names)) for r in rows} <= said and (name not in ("lines", "mix") or len(rows) == df.count())
    assert corpus_pipeline.STAGES[-1][1](spark, df, "").count() == df.count()
    kept = corpus_pipeline.language(spark, df, "").collect()
    assert len(kept) == sum(r.text is not None and any(map(str.isalpha, r.text)) for r in df.collect()) and lang_id.UNKNOWN not in {r.lang for r in kept}
    near = corpus_pipeline.near_duplicates(spark, df, "")
    assert Counter(r.doc_id for r in near.collect()) == Counter(r.doc_id for r in df.collect() if r.doc_id != 5)
    df.write.parquet(f"file://{tmp_path}/documents.parquet")
    ids = corpus_pipeline.run(spark, f"file://{tmp_path}").collect()
    assert all(r.exact for r in ids) and bool(ids) != empty


def test_columns_of_queries(spark):
    """What each query returns on a whole table: the columns of its contract
    and a row for each input row."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id").collect()
    want = {
        "op1_token_files": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
        "op2_minhash": {"doc_id": "bigint", "copy_of": "bigint", "class_id": "bigint", "kept": "boolean"},
        "op3_byte_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
        "op5_line_dedup": {"doc_id": "bigint", "n_lines": "bigint", "n_dropped": "bigint", "kept_sha256": "string"},
        "op6_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
        "op7_source_mix": {"doc_id": "bigint", "source": "string", "block": "bigint", "slot": "bigint", "position": "bigint"},
        "op8_quality_ledger": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
        "op10_pii_surrogates": {"doc_id": "bigint", "text": "string", "n_name": "bigint"},
    }
    for name, columns in want.items():
        got = queries.queries()[name](spark, "/root/testdata/sf0.001")
        kinds = dict(got.dtypes)
        assert {c: kinds.get(c) for c in columns} == columns, name
        rows = got.select(*columns).collect()
        assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs), name
    got = queries.op9_embedding_dedup(spark, "/root/testdata/sf0.001")
    assert {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"}.items() <= dict(got.dtypes).items()
    assert got.count() == spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").count()


def test_every_query_runs(spark):
    for name, query in queries.queries().items():
        assert len(query(spark, "/root/testdata/sf0.001").limit(1).collect()) == 1, name
