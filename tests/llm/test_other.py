"""Vectors, archives, components, the registered queries and the pipeline."""

import collections
import hashlib
import os
import random
import re
from io import BytesIO

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe_codec, cells, common, components, mixing, ngram_join, queries, topk_taat, vptree, warc
from tidemark.llm import vectors as vector_module

SMALL = "/root/testdata/sf0.001"


def vectors(spark, rows, schema="vec_id LONG, embedding ARRAY<FLOAT>, label INT"):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], schema)


def random_rows(n, dims, seed, clusters=0):
    r = np.random.default_rng(seed)
    m = r.normal(size=(n, dims))
    if clusters:
        m = r.normal(size=(clusters, dims))[r.integers(0, clusters, n)] + 0.1 * m
    return [(i, [float(x) for x in np.float32(v)]) for i, v in enumerate(m)]


ODD = [(50, None), (51, []), (52, [0.0, 0.0, 0.0]), (53, [1.0, None, 2.0]), (54, [float("nan"), 1.0, 1.0]), (55, [float("inf"), 1.0, 1.0]), (100, [1.0, 2.0, 3.0]), (None, [1.0, 2.0, 3.0]), (100, [1.0, 2.0, 3.0]), (101, [1.0, 2.0, 3.0]), (99, [1.0, 2.0, 3.0]), (150, [-1.0, 2.0]), (151, [1e30, 1.0, 1.0])]


def usable(rows, zero_too=True):
    ok = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and (zero_too or any(v)):
            ok[i, tuple(v)] = [float(np.float32(x)) for x in v]
    return [(i, v) for (i, _), v in ok.items()]


def brute(rows, score, k=5, zero_too=True):
    rows = usable(rows, zero_too)
    width = max((len(v) for _, v in rows), default=0)
    rows = [(i, v + [0.0] * (width - len(v))) for i, v in rows]
    out = []
    for q, a in rows:
        if q % 50 == 0:
            best = sorted(((-score(a, b), i) for i, b in rows if i != q))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


def dot(a, b):
    return sum(int(np.floor(256 * x)) * int(np.floor(256 * y)) for x, y in zip(a, b))


def cosine(a, b):
    a, b = np.array(a), np.array(b)
    return float(a @ b / np.sqrt(a @ a) / np.sqrt(b @ b))


SIGNS = [[1.0 if n >> k & 1 else -1.0 for k in range(8)] for n in range(256)]
POWERS = [(i, [2.0 ** (i % 13 - 6) * x for x in (1.0, 3.0, -2.0, 0.5)]) for i in range(1, 31)] + [(50, [1.0, 3.0, -2.0, 0.5])]
SCALED = [(i, [float(np.float32(x * (1 + i * 0.37))) for x in (0.3, -1.1, 0.77)]) for i in range(600)]
TIES = [(i, SIGNS[i * 7 % 256]) for i in range(500)]


@pytest.mark.parametrize("rows", [random_rows(400, 16, 1), random_rows(300, 3, 2) + [(i, [1.0, 2.0, 3.0]) for i in range(300, 420)], ODD, []])
def test_top_k_equals_brute_force(spark, rows):
    df = vectors(spark, rows)
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk_taat.top_k(df, df.where("vec_id % 50 = 0")).collect())
    want = [w if abs(w[3]) < 2**63 else (*w[:3], (2**63 - 1) if w[3] > 0 else -(2**63)) for w in brute(rows, dot)]
    assert got == want


@pytest.mark.parametrize("rows", [random_rows(500, 6, 21) * 2 + [(77, [float(x)] * 6) for x in range(40)] * 3, random_rows(300, 3, 22) + [(i, [1e30, 1.0, 1.0]) for i in range(300, 320)], TIES + [(50, [1.0] * 8), (50, [2.0] * 8)]])
def test_top_k_in_small_blocks(spark, monkeypatch, rows):
    """Shards, slabs and blocks of a few rows: repeats that lie in two blocks count once, ties go to the smaller id."""
    for name, value in (("SHARD_ROWS", 90), ("SLAB_BYTES", 200), ("STREAM_ROWS", 7), ("BLOCK_ROWS", 3)):
        monkeypatch.setattr(vector_module, name, value)
    df = vectors(spark, rows)
    found = topk_taat.top_k(df, df.where("vec_id % 50 = 0"))
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found.collect())
    assert got == brute(rows, lambda a, b: min(max(dot(a, b), -(2**63)), 2**63 - 1))


def test_a_slab_meets_blocks_in_turn():
    slab = topk_taat.Slab(2, 1.0)
    slab.ask(np.array([4, 9]), np.array([0, 0]), np.array([[1.0, 0.0], [0.0, 1.0]]))
    for ids, m in (([1, 2], [[5, 1], [5, 2]]), ([2, 4], [[5, 2], [9, 9]]), ([4, 7, 9], [[9, 9], [5, 9], [6, 99]])):
        slab.meet(np.array(ids), np.array(m, dtype=float))
    (q, _, v, s), = slab.found()
    assert list(zip(q, v, s)) == [(4, 9, 6), (4, 1, 5), (9, 4, 9), (9, 7, 9)]


@pytest.mark.parametrize("rows", [random_rows(600, 8, 3), random_rows(500, 12, 4, clusters=9), random_rows(200, 3, 5) + [(i, [1.0, 2.0, 3.0]) for i in range(200, 330)], ODD, []])
def test_factor_one_is_exact(spark, rows):
    df = vectors(spark, rows)
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in vptree.nearest(df, df.where("vec_id % 50 = 0"), factor=1.0).collect())
    want = brute(rows, cosine, zero_too=False)
    assert [g[:2] for g in got] == [w[:2] for w in want] and all(abs(g[3] - w[3]) < 1e-9 for g, w in zip(got, want))
    assert sum(g[2] == w[2] for g, w in zip(got, want)) >= 0.99 * len(want)


def exact_neighbours(rows, k=5):
    """By numpy, with the same sums: (query, rank, id, cosine)."""
    rows = usable(rows, zero_too=False)
    ids, m = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    norm = np.sqrt((m * m).sum(axis=1))
    out = []
    for q in np.flatnonzero(ids % 50 == 0):
        score = (m * m[q]).sum(axis=1) / (norm * norm[q])
        other = np.flatnonzero(ids != ids[q])
        best = other[np.lexsort((ids[other], -score[other]))][:k]
        out += [(int(ids[q]), r + 1, int(ids[i]), float(score[i])) for r, i in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("rows", [POWERS, SCALED, TIES, TIES + [(50, [1.0] * 8), (50, [2.0] * 8), (50, [1.0] * 7 + [-1.0])]])
def test_ties_go_to_the_smaller_id(spark, rows):
    df = vectors(spark, rows)
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in vptree.nearest(df, df.where("vec_id % 50 = 0"), factor=1.0).collect())
    asked = {g[0] for g in got}
    want = exact_neighbours(rows)
    if len({i for i, _ in rows}) == len(rows):
        assert got == [w for w in want if w[0] in asked] and 50 in asked
    assert all(g[0] != g[2] for g in got)


@pytest.mark.parametrize("clusters", [0, 40])
def test_recall_with_the_production_factor(spark, clusters):
    rows = random_rows(3000, 32, 6, clusters)
    df = vectors(spark, rows)
    got = {(r["query_id"], r["vec_id"]) for r in vptree.nearest(df, df.where("vec_id % 50 = 0")).collect()}
    m = np.array([v for _, v in rows])
    u = m / np.linalg.norm(m, axis=1)[:, None]
    want = set()
    for q in range(0, 3000, 50):
        s = u @ u[q]
        s[q] = -9
        want |= {(q, int(i)) for i in np.argsort(-s)[:5]}
    assert len(got & want) / len(want) >= 0.9


@pytest.mark.parametrize("rows", [random_rows(900, 6, 11, clusters=7), random_rows(400, 3, 12) + [(i, [0.5, -1.0, 2.0]) for i in range(400, 900)], TIES])
def test_cells_in_parts_and_queries_in_slabs(spark, monkeypatch, rows):
    """Small parts and slabs, so that each cell is cut: as exact as before."""
    monkeypatch.setattr(cells, "PART_BYTES", 4000)
    monkeypatch.setattr(vector_module, "SLAB_ROWS", 3)
    df = vectors(spark, rows)
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in vptree.nearest(df, df.where("vec_id % 50 = 0"), factor=1.0).collect())
    want = brute(rows, cosine, zero_too=False)
    assert [g[:2] for g in got] == [w[:2] for w in want] and all(abs(g[3] - w[3]) < 1e-9 for g, w in zip(got, want))
    assert got == exact_neighbours(rows)


def test_queries_visit_few_cells(spark):
    """Of clustered vectors; copies of one vector are one pivot, and cells that no query comes to are not sent."""
    rows = random_rows(6400, 16, 13, clusters=40) + [(i, [1.0] * 16) for i in range(6400, 9600)]
    df = vector_module.usable(vectors(spark, rows), "vec_id", "embedding")
    grid = cells.Cells(df)
    assert len(grid.pivots) == len(np.unique(grid.pivots, axis=0)) == 13
    asked = vector_module.tagged(df.where("id % 50 = 0")).withColumn("least", F.lit(0.98))
    n = grid.visits(asked, 1.0, vptree.SLACK).select(F.avg(F.size("cells")).alias("n")).first()["n"]
    assert n < 4
    assert grid.meet(grid.place(asked).where("cell < 0")).count() == 0


def test_recall_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = {(r["query_id"], r["vec_id"]) for r in vptree.nearest(df, df.where("vec_id % 50 = 0")).collect()}
    exact = {(r["query_id"], r["vec_id"]) for r in vptree.nearest(df, df.where("vec_id % 50 = 0"), factor=1.0).collect()}
    import duckdb

    con = duckdb.connect()
    con.execute("create view embeddings as select * from read_parquet('/root/testdata/sf0.1/embeddings.parquet')")
    want = {(r[0], r[2]) for r in con.execute(queries.EXACT_NEAREST_SQL).fetchall()}
    assert exact == want and len(got & want) / len(want) >= 0.9


def test_pruning_skips_leaves_and_a_larger_factor_more():
    rows = random_rows(4000, 3, 7)
    ids, m = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    visits = []
    for factor in (1.0, 3.0):
        tree = vptree.Tree(ids, m, 5)
        n = [0]
        leaf = tree._leaf
        tree._leaf = lambda places, who, n=n, leaf=leaf: (n.__setitem__(0, n[0] + len(who)), leaf(places, who))
        tree.search(np.full(50, -1), tree.points[:50], np.ones(50), np.full(50, -np.inf), factor)
        visits.append(n[0])
    leaves = 4000 / vptree.LEAF
    assert visits[1] < visits[0] < 50 * leaves * 0.5


# 7 --------------------------------------------------------------------------


PAGES = "page_id LONG, url STRING, html STRING, extra STRING"


def brute_pages(rows, least=0):
    first = {}
    for i, _, h in rows:
        p = (h or "").encode()
        if i is not None and len(p) >= least:
            first[p] = min(first.get(p, i), i)
    out = []
    for i, _, h in rows:
        p = (h or "").encode()
        rev = len(p) >= least and p in first and i != first[p]
        out.append((i, len(p), warc.payload_digest(p), "revisit" if rev else "response", first[p] if rev else None))
    return collections.Counter(out)


def read_back(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x") for r in rows], PAGES)
    manifest = warc.write_archives(df, **options)
    got = warc.read_archives(manifest)
    return collections.Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got.collect()), manifest, got


@pytest.mark.parametrize("least", [0, 5])
def test_archives_hold_every_page_once(spark, least):
    r = random.Random(1)
    rows = [(i, f"http://x/{i}", r.choice(["same page", "<p>é日本</p>\r\n\r\nWARC/1.1\r\n", "", None, f"page {i}", "abc"])) for i in range(80)] + [(None, None, "same page"), (3, "http://x/3", "same page"), (200, "bad\r\nurl", "z" * 70000)]
    got, manifest, back = read_back(spark, rows, min_bytes=least, archive_bytes=2000)
    assert got == brute_pages(rows, least) and manifest.count() > 5
    full = {x["page_id"]: x["html"] for x in back.collect() if x["record_type"] == "response" and x["page_id"] is not None}
    assert full[200] == "z" * 70000 and all(full[i] == (h or "") for i, _, h in rows if i in full and i != 3)


def test_filters_that_are_full_change_no_record(spark, monkeypatch):
    r = random.Random(2)
    rows = [(i, None, r.choice(["same page", "other page", f"page {i}", f"page {i}", None])) for i in range(200)] + [(None, "u", "page 3"), (None, None, "alone"), (None, "v", "alone")]
    for bits in (4, 8):
        monkeypatch.setattr(warc, "FILTER_BITS", bits)
        assert read_back(spark, rows)[0] == brute_pages(rows)


def test_stores_by_their_names_in_spark(spark, tmp_path):
    from pyarrow import fs

    assert warc.open_store("file:///a/b") == (fs.LocalFileSystem(), "/a/b") and warc.open_store("dbfs:/a/b") == (fs.LocalFileSystem(), "/dbfs/a/b")
    for uri, kind, path in (("s3a://bucket/a", "S3FileSystem", "bucket/a"), ("gs://bucket/a", "GcsFileSystem", "bucket/a"), ("abfss://box@acct.dfs.core.windows.net/a", "AzureFileSystem", "box/a")):
        if hasattr(fs, kind):
            store, at = warc.open_store(uri)
            assert type(store).__name__ == kind and at == path
    df = spark.createDataFrame([(1, "http://a", "hello", None), (2, "http://b", "hello", None)], PAGES)
    with pytest.raises(ValueError, match="give one by `store`"):
        warc.write_archives(df, "odd://x/y")
    root = str(tmp_path)

    def mine(uri):
        from pyarrow import fs

        return fs.LocalFileSystem(), root + "/" + uri.removeprefix("odd://")

    manifest = warc.write_archives(df, "odd://x/y", store=mine)
    assert sorted(r["record_type"] for r in warc.read_archives(manifest, store=mine).collect()) == ["response", "revisit"]


def test_archive_of_nothing(spark):
    got, manifest, _ = read_back(spark, [])
    assert not got and manifest.count() == 0


def test_archives_are_plain_warc(spark, tmp_path):
    import gzip

    df = spark.createDataFrame([(1, "http://a", "hello", None), (2, "http://b", "hello", None)], PAGES)
    path = warc.write_archives(df.coalesce(1), "file://" + str(tmp_path / "w")).collect()
    text = b"".join(gzip.open(p["path"].removeprefix("file://")).read() for p in path)
    records = list(warc.parse(BytesIO(text)))
    assert [h["warc-type"] for h, _ in sorted(records, key=lambda x: x[0]["x-page-id"])] == ["response", "revisit"]
    rev = next(h for h, _ in records if h["warc-type"] == "revisit")
    assert rev["warc-refers-to-target-uri"] == "http://a" and rev["warc-profile"] == warc.PROFILE and len({h["warc-record-id"] for h, _ in records}) == 2


def test_a_spoilt_archive_is_noticed(spark, tmp_path):
    df = spark.createDataFrame([(1, "http://a", "hello", None)], PAGES)
    m = warc.write_archives(df, "file://" + str(tmp_path / "w"))
    p = m.first()["path"].removeprefix("file://")
    import gzip

    data = gzip.open(p).read().replace(b"hello", b"hallo")
    open(p, "wb").write(gzip.compress(data))
    with pytest.raises(Exception, match="does not match its digest"):
        warc.read_archives(m).collect()


# components -------------------------------------------------------------------


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 50)] + [(60, i) for i in range(61, 70)] + [(49, 61)], None])
def test_components(spark, edges):
    if edges is None:
        r = random.Random(2)
        edges = [(r.randrange(300), r.randrange(300)) for _ in range(170)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a LONG, b LONG")).collect()}
    assert got == {x: find(x) for x in list(root) if find(x) != x}


# queries and pipeline -----------------------------------------------------------


def test_registered_queries_equal_their_sql(spark):
    import os

    import duckdb

    con = duckdb.connect()
    for f in os.listdir(SMALL):
        con.execute(f"create view {f.split('.')[0]} as select * from read_parquet('{SMALL}/{f}')")
    shown = lambda rows: sorted(tuple(f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in rows)
    for name, sql in queries.ORACLE.items():
        df = queries.QUERIES[name](spark, SMALL)
        got = con.execute(sql)
        names = [d[0] for d in got.description]
        assert shown(df.select(*names).collect()) == shown(got.fetchall()), name
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{k}" for k in range(1, 14)}


CLASHING = ["score", "lang_pred", "__text", "__ld_keep", "__near1", "__words", "__mix1", "copies", "row", "keep", "key1", "key2", "n", "copy", "doc", "at", "words", "size", "target", "taken"]


def test_pipeline_stages_leave_other_columns_alone(spark):
    import corpus_pipeline as p

    base = spark.read.parquet(f"{SMALL}/documents.parquet").where("n_chars < 800").limit(60)
    more = [F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")).alias(c) for c in CLASHING]
    docs = base.select("*", *more, F.create_map(F.lit("k"), F.col("source")).alias("tags"), F.array("lang").alias("a.dotted name"))
    want = {r["doc_id"]: r for r in docs.collect()}
    for name, stage in p.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SMALL).collect(), docs.schema)
        got = docs.collect()
        assert got and docs.columns == list(want[got[0]["doc_id"]].asDict()), name
        for r in got:
            same = [c for c in docs.columns if c not in ("text", "n_chars")]
            assert [r[c] for c in same] == [want[r["doc_id"]][c] for c in same], name


def brute_pipeline(rows):
    """All stages by plain loops over (id, text, lang, source): what the last stage gives, counted."""
    import tiktoken
    from test_text import MULTI, brute_language, brute_near, brute_targets

    ranks = bpe_codec.read_ranks(MULTI)
    import public_tokenizers

    tik = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    white = " \t\n\x0b\x0c\r"
    rows = [r for r, (lang, _) in zip(rows, brute_language([r[:3] for r in rows])) if lang != "und"]
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(white))
    owner = {}
    for d, text, *_ in rows:
        for line in text.split("\n"):
            owner[key(line)] = min(owner.get(key(line), d), d)
    rows = [(d, "\n".join(x for x in t.split("\n") if len(key(x)) < 10 or owner[key(x)] == d), lang, source) for d, t, lang, source in rows]
    first = {d: c for d, _, c in brute_near([r[:2] for r in rows])}
    rows = [r for r in rows if first[r[0]] == r[0]]
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    sizes = collections.Counter()
    for _, t, _, s in rows:
        sizes[s] += words(t)
    targets = brute_targets(sizes)
    out = collections.Counter()
    for s in sizes:
        ratio, u = min(targets[s] / sizes[s], 3.0) if sizes[s] else 0.0, mixing.offset(7, s)
        for k, (_, d, t) in enumerate(sorted((words(t), d, t) for d, t, _, x in rows if x == s), 1):
            ids = tik.encode_ordinary(t)
            digest = lambda b: hashlib.sha256(b).hexdigest()
            out[d, len(ids), digest(np.array(ids, "<u4").tobytes()), digest(t.encode())] += int(np.floor(ratio * k + u) - np.floor(ratio * (k - 1) + u))
    return +out


def test_pipeline_equals_brute_force(spark, tmp_path):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("n_chars < 1500")
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in docs.collect()]
    rows += [(9000, "12 34 !!", "en", "a"), (9001, None, "en", None), (9002, "kurz", None, None), (9003, "kurz", None, "z"), (9004, "a line that comes twice\n" + rows[0][1], "en", None), (9005, "A line that comes TWICE ", "en", "web")]
    spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, source STRING").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = p.run(spark, str(tmp_path))
    assert collections.Counter(tuple(r) for r in got.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()) == brute_pipeline(rows)
    # of all that was written on the way the last result alone is left
    with common.intermediates(spark) as made:
        p.run(spark, str(tmp_path)).count()
        left = [x for x in made if os.path.exists(x.removeprefix("file://").removeprefix("file:"))]
    assert len(left) == 1 and "stage-encode" in left[0]


def test_intermediates_need_a_shared_folder(spark, monkeypatch):
    class Elsewhere:
        conf = type("Conf", (), {"get": staticmethod(lambda *a: None)})
        sparkContext = type("Context", (), {"master": "spark://host:7077", "_jsc": spark.sparkContext._jsc})

    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            common.shared_dir(Elsewhere)


def test_pipeline_over_nothing(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in p.STAGES:
        docs = stage(spark, docs, SMALL)
        assert docs.count() == 0
