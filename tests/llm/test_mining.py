"""Hard negatives, chat formatting and collocations against plain Python."""

import collections
import hashlib
import random
import re
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat_format, collocations, hard_negatives

# hard negatives ------------------------------------------------------------------------------------------------------------------


def labelled(spark, rows):
    return spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<FLOAT>, label INT").select("*", *[F.lit("x").alias(c) for c in ("id", "tag", "side", "shard", "slab", "codes", "norms", "windows", "w", "nth")])


def integer(v):
    return [int(np.floor(256 * float(np.float32(x)))) for x in v]


def plain_negatives(rows):
    ok = {(i, label, tuple(map(float, np.float32(v)))): (i, label, integer(v)) for i, v, label in rows if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    clip = lambda x: max(min(x, 2**63 - 1), -(2**63))
    for q, label, a in ok.values():
        if q % 50:
            continue
        scored = sorted((-clip(sum(x * y for x, y in zip(a, v))), i, other == label) for i, other, v in ok.values() if i != q)
        for ps, p, _ in [s for s in scored if s[2]][:5]:
            hits = [(i, -s) for s, i, same in scored if not same and 50 * -ps <= 100 * -s <= 95 * -ps][:3]
            out += [(q, p, r + 1, i, -ps, s) for r, (i, s) in enumerate(hits)]
    return sorted(out)


def mined(df, **more):
    found = hard_negatives.hard_negatives(df, df.where("vec_id % 50 = 0"), **more)
    return sorted((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in found.collect())


def clustered(n, dims, seed, labels=4):
    r = np.random.default_rng(seed)
    middle = r.normal(size=(labels, dims)) + 1.0
    return [(i, [float(x) for x in np.float32(middle[i * 7 % labels] + 0.4 * r.normal(size=dims))], int(i * 7 % labels)) for i in range(n)]


EDGE = [(50, [1.0, 2.0], 1), (50, [1.0, 2.0], 1), (50, [2.0, 1.0], 2), (51, [1.0, 2.0], 1), (51, [1.0, 2.0], 1), (52, [1.0, 1.5], 2), (53, [1.0, 1.5], 2), (54, None, 1), (55, [1.0, None], 1), (56, [float("nan"), 1.0], 1), (57, [1.0, 1.0], None), (None, [1.0, 1.0], 1), (58, [], 1), (59, [1.0], 3), (60, [0.0, 0.0], 2), (100, [-1.0, -1.0], 1), (101, [1e30, 1.0], 1), (102, [9e29, -5.0], 2), (103, [6e29, 1.0, 7.0], 3), (150, [1e30, 0.0], 1)]


@pytest.mark.parametrize("rows", [clustered(600, 10, 1), [(i, v, 0 if i % 3 else i % 5) for i, v, _ in clustered(500, 6, 2)], [(i, [float(i % 4), 1.0, float(i % 7)], i % 2) for i in range(400)], EDGE, []])
def test_negatives_equal_brute_force(spark, rows):
    assert mined(labelled(spark, rows)) == plain_negatives(rows)


def test_negatives_in_small_shards_slabs_and_blocks(spark, monkeypatch):
    rows = [(i % 450, v, label) for i, v, label in clustered(500, 6, 5)] * 2
    for name, value in (("SLAB_BYTES", 100), ("BLOCK", 7), ("ANCHORS", 3), ("SAMPLE_ROWS", 40), ("CODES", 8)):
        monkeypatch.setattr(hard_negatives, name, value)
    assert mined(labelled(spark, rows)) == plain_negatives(rows)


def test_bounds_hold_and_leave_rows_out():
    r = np.random.default_rng(3)
    x = np.floor(256 * (r.normal(size=(40, 16))[r.integers(0, 40, 3000)] + 0.05 * r.normal(size=(3000, 16))))
    book = hard_negatives.Codebook(x[:1000], 16)
    codes, norms = book.encode(x)
    tables, sizes, slack = book.tables(x[:20])
    score = sum(t[:, c] for t, c in zip(tables, codes.T))
    reach = sizes @ norms.T.astype(float) + slack[:, None]
    true = x[:20] @ x.T
    assert (np.abs(true - score) <= reach).all()
    assert (score + reach < np.partition(score - reach, -5, axis=1)[:, -5:].min(axis=1)[:, None]).mean() > 0.5


# chat formatting -----------------------------------------------------------------------------------------------------------------

PIECES = ["<|turn|>", "<|end|>", "</s>", "<s>", "[INST]", "[/INST]", "<nl>", "<|image|>", "<|x y|>", "\\", "<", "[", "|>", "\n", " ok ", "é日👩", "<\\/s>", "[\\\\INST]", "<|", "<nl", "$1"]


def odd_text(r):
    return "".join(r.choices(PIECES, k=r.randint(0, 9)))


def chats(spark, rows):
    df = spark.createDataFrame(rows, "conv_id LONG, turn LONG, role STRING, text STRING")
    return df.select("*", chat_format.text_parts(F.col("text")).alias("parts"), *[F.lit(1).alias(c) for c in ("conv", "pos", "part", "p", "at", "piece", "formatted", "segments")])


def plain_chats(rows):
    convs = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        learned = "".join(t for _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest())
    return out


def test_chats_read_back_as_they_were(spark):
    r = random.Random(4)
    rows = [(c, t, r.choice(["user", "assistant", "assistant", "system", "odd\n<nl>role<|end|>", "<|turn|>", None]), r.choice([odd_text(r), odd_text(r), None, "", "x" * 3000])) for c in range(60) for t in range(r.randint(1, 7))]
    rows += [(None, 1, "user", "a"), (None, 0, "assistant", "b"), (7, None, "assistant", "first"), (8, 1, "assistant", "same"), (8, 1, "assistant", "same"), (8, 1, "user", "tie")]
    made = chat_format.formatted(chats(spark, rows))
    got = {g["conv_id"]: (g["n_turns"], g["turns_sha256"], g["loss_chars"], g["loss_sha256"]) for g in chat_format.digests(made).collect()}
    assert got == plain_chats(rows)
    control = re.compile(r"<(?:\|[^<|\[\\]*\|>|/?s>|nl>)|\[/?INST\]")
    for g in made.collect():
        text = g["formatted"]
        assert {m for m in control.findall(text)} <= {"<|turn|>", "<|end|>", "<nl>"}
        turns = [n.start() for n in re.finditer(re.escape("<|turn|>"), text)]
        for s in g["loss"]:
            assert s["at"] == turns[s["turn_no"] - 1] + len("<|turn|>") + s["within"]
            assert text[s["at"] + s["chars"] :].startswith("<|end|>\n")


def test_escaping_is_one_to_one(spark):
    texts = ["".join(p) for n in range(4) for p in product(["<", "\\", "/s>", "[", "INST]", "|a|>"], repeat=n)]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING").select("t", chat_format.escaped(F.col("t")).alias("e"))
    rows = df.withColumn("back", chat_format.unescaped(F.col("e"))).collect()
    assert all(r["back"] == r["t"] for r in rows) and len({r["e"] for r in rows}) == len(texts)
    assert not any(re.search(r"<(?:/s>|\|a\|>)|\[INST\]", r["e"]) for r in rows)


def test_parts_become_placeholders_in_order(spark):
    part = lambda kind=None, text=None, ref=None, width=None, height=None, seconds=None, pages=None: (kind, text, ref, width, height, seconds, pages)
    rows = [
        (1, 0, "user", [part("text", "look <|image|>: "), part("image", ref="a.png", width=57, height=28), part("audio", ref="b.wav", seconds=1.5)]),
        (1, 1, "assistant", [part("text", "one"), part("document", ref="c.pdf", pages=3), part("text", "two"), part("film", ref="d"), None]),
        (1, 2, "user", []),
        (1, 3, "user", None),
        (1, 4, "user", [part("image", width=-5), part("text", None), part("image", ref="e", width=10, height=10)]),
    ]
    df = spark.createDataFrame(rows, f"conv_id LONG, turn LONG, role STRING, parts {chat_format.PARTS}")
    (g,) = chat_format.formatted(df).collect()
    assert g["formatted"] == (
        "<|turn|>user\nlook <\\|image|>: <|image|><|audio|><|end|>\n<|turn|>assistant\none<|document|>two<|other|><|end|>\n<|turn|>user\n<|end|>\n<|turn|>user\n<|end|>\n<|turn|>user\n<|image|><|image|><|end|>\n"
    )
    assert [(a["number"], a["turn_no"], a["kind"], a["ref"], a["tokens"]) for a in g["attachments"]] == [(1, 1, "image", "a.png", 3), (2, 1, "audio", "b.wav", 38), (3, 2, "document", "c.pdf", 3072), (4, 2, "other", "d", 0), (5, 5, "image", None, 0), (6, 5, "image", "e", 1)]
    assert all(g["formatted"][a["at"] :].startswith(f"<|{a['kind']}|>") for a in g["attachments"]) and g["attachment_tokens"] == 3 + 38 + 3072 + 1
    assert [g["formatted"][s["at"] : s["at"] + s["chars"]] for s in g["loss"]] == ["one", "two", ""]
    assert chat_format.read_back(chat_format.formatted(df)).first()["learned"] == "onetwo"
    assert chat_format.formatted(df.limit(0)).count() == 0


def test_chats_are_formatted_without_python(spark):
    plan = chat_format.digests(chat_format.formatted(chats(spark, [(1, 1, "user", "a")])))._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# collocations --------------------------------------------------------------------------------------------------------------------


def plain_collocations(docs, least, top=2000):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", "".join(c.lower() if c.isascii() else c for c in text or "")):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, count in f.items():
        some = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        longer = collections.Counter()
        for p, a in some.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    longer[p[i : i + m]] = max(longer[p[i : i + m]], a)
        rows = []
        for p, a in some.items():
            if 100 * longer[p] >= 80 * a:
                continue
            score, _, left, right = min((2_000_000 * a // (count[p[:k]] + count[p[k:]]), k, count[p[:k]], count[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top])]
    return sorted(out)


def phrases(spark, docs, **more):
    df = spark.createDataFrame(docs, "text STRING, lang STRING").select("*", *[F.lit("x").alias(c) for c in ("phrase", "n", "words", "size", "a", "l", "k", "cut")])
    return sorted(tuple(r) for r in collocations.collocations(df, **more).collect())


def odd_documents(seed):
    r = random.Random(seed)
    words = ["a", "b", "C", "é", "日本", "x" * 40, " ", "A-b", "\x00", "d e", "'"]
    text = lambda: "".join(r.choice(words) + r.choice([" ", " ", " ", "\t ", ". ", ",", "\n", "\x0b", "\r\n", ":", " ; "]) for _ in range(r.randint(0, 60)))
    docs = [(text(), r.choice(["en", "de", "und", None])) for _ in range(80)]
    return docs + [(None, "en"), ("", None), ("one", "xx"), ("a b c d " * 200, "de"), ("a a a a a a a a a", "en")] + [("Same old thing again", "en")] * 40


@pytest.mark.parametrize("seed, least", [(1, 30), (2, 5), (3, 1)])
def test_collocations_equal_plain_counting(spark, monkeypatch, seed, least):
    docs = odd_documents(seed)
    if seed == 2:
        monkeypatch.setattr(collocations, "SHARD_BYTES", 200)
    assert phrases(spark, docs, least=least) == plain_collocations(docs, least)


def test_collocations_with_a_filter_that_lets_all_through(spark, monkeypatch):
    monkeypatch.setattr(collocations, "LEAST_BITS", 3)
    monkeypatch.setattr(collocations, "MOST_BITS", 3)
    docs = odd_documents(4)
    assert phrases(spark, docs, least=4, top=7) == plain_collocations(docs, 4, 7)


def test_collocations_of_nothing(spark):
    assert phrases(spark, [], least=1) == [] and phrases(spark, [(None, None), ("", "en"), (" . ", "en")], least=1) == []
