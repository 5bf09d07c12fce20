"""The pipeline against a plain Python version of all five stages."""

from __future__ import annotations

import hashlib
import math
import os
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from voxelith.llm import bpe_codec, quality

SF = "/root/testdata/sf0.001"
SPACE = r"[\x20\x09-\x0d]+"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


def plain_model(texts):
    grams = lambda t: [tuple((["start"] * 3 + [quality.symbol_of(c) for c in t])[i : i + 4]) for i in range(len(t))]
    tables = {4: Counter(g for t in texts for g in grams(t))}
    for k in (3, 2, 1):
        tables[k] = Counter(g[1:] for g in tables[k + 1])
    discount, total, held = {}, defaultdict(float), defaultdict(float)
    for k, t in tables.items():
        n = [sum(v == i for v in t.values()) for i in range(5)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
        discount[k] = [max(0.0, min(i, i - (i + 1) * y * n[i + 1] / n[i])) if n[i] and n[i + 1] else 0.5 for i in (1, 2, 3)]
        for g, v in t.items():
            total[g[:-1]] += v
            held[g[:-1]] += discount[k][min(v, 3) - 1]
    memo: dict = {(): 1 / (len(tables[1]) + 1)}

    def p(g):
        if g not in memo:
            below, k, ctx = p(g[1:]), len(g), g[:-1]
            v = tables[k].get(g, 0)
            memo[g] = below if not total[ctx] else ((v - discount[k][min(v, 3) - 1]) / total[ctx] if v else 0) + held[ctx] / total[ctx] * below
        return memo[g]

    return lambda t: -sum(math.log(p(g)) for g in grams(t)) / len(t)


def keep_quality(docs, labels, draw):
    verdict = {}
    for i, q, x in labels:
        verdict[i] = verdict.get(i, True) and q == 1 and not x
    sample = [d for d in docs if d["text"] and verdict.get(d["doc_id"])]
    fit = [d["text"] for d in sample if draw[d["doc_id"]] % 2 == 0]
    score = plain_model(fit)
    groups = defaultdict(list)
    for d in sample:
        s, w = score(d["text"]), quality.SPREAD / math.sqrt(len(d["text"]))
        for key in (d["lang"], None):
            groups[key].append((s + w, s - w, draw[d["doc_id"]] % 2 == 0))
    bounds = {}
    for key, rows in groups.items():
        if key is None or len(rows) >= quality.LEAST_DOCS:
            unseen = [r[1] for r in rows if not r[2]]
            bounds[key] = np.quantile([r[0] for r in rows], quality.LOW) * (1 - quality.MARGIN), np.quantile(unseen, quality.HIGH) * (1 + quality.MARGIN)
    out = []
    for d in docs:
        if d["text"]:
            low, high = bounds.get(d["lang"], bounds[None])
            s, w = score(d["text"]), quality.SPREAD / math.sqrt(len(d["text"]))
            if s + w >= low and s - w <= high:
                out.append(d)
    return out


def drop_copies(docs):
    best = {}
    for d in docs:
        key = re.sub(SPACE, " ", d["text"])
        if key not in best or d["doc_id"] < best[key]["doc_id"]:
            best[key] = d
    return list(best.values())


def drop_near(docs):
    sets = {}
    for d in docs:
        w = re.findall(r"[^\x20\x09-\x0d]+", d["text"].lower() if d["text"].isascii() else re.sub("[A-Z]", lambda m: m[0].lower(), d["text"]))
        sets[d["doc_id"]] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [d for d in docs if find(d["doc_id"]) == d["doc_id"]]


def mix(docs):
    size = {d["doc_id"]: len(re.findall(r"[^\x20\x09-\x0d]+", d["text"])) for d in docs}
    total = Counter()
    for d in docs:
        total[d["source"]] += size[d["doc_id"]]
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(order)}
    fixed: dict = {}
    while True:
        free = [s for s in order if s not in fixed]
        share = {s: (sum(total.values()) - sum(fixed.values())) / sum(weight[f] for f in free) * weight[s] for s in free}
        over = [s for s in free if share[s] >= 3 * total[s]]
        if not over:
            break
        fixed |= {s: 3.0 * total[s] for s in over}
    target = fixed | share
    out = []
    for s in order:
        whole = int(target[s] // total[s]) if total[s] else 0
        rest, before = target[s] - whole * total[s], 0
        for d in sorted((d for d in docs if d["source"] == s), key=lambda d: hashlib.md5(f"voxelith:{d['doc_id']}:{hashlib.md5(d['text'].encode()).hexdigest()}".encode()).hexdigest()):
            n = size[d["doc_id"]]
            out += [d] * (whole + (rest > 0 and 2 * before + n <= 2 * rest))
            before += n
    return out


def test_pipeline(spark, monkeypatch):
    from pyspark.sql import functions as F
    from tokenizers import Tokenizer

    docs = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    draw = {r.doc_id: r.d for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.pmod(F.xxhash64(F.lit("quality"), "doc_id"), F.lit(1 << 20)).alias("d")).collect()}
    labels = [tuple(r) for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    kept = keep_quality(docs, labels, draw)
    assert 0.7 * len(docs) < len(kept) < len(docs)
    mixed = mix(drop_near(drop_copies(kept)))
    tokenizer = Tokenizer.from_file(bpe_codec.default_path())
    expected = []
    for d in mixed:
        ids = tokenizer.encode(d["text"], add_special_tokens=False).ids
        expected.append((d["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    seen = []

    def watched(name, stage):
        def call(session, frame, folder):
            out = stage(session, frame, folder)
            seen.append((name, out.columns == frame.columns))
            return out

        return name, call

    monkeypatch.setattr(corpus_pipeline, "STAGES", [watched(*s) for s in corpus_pipeline.STAGES])
    got = corpus_pipeline.run(spark, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(expected)
    assert seen == [("quality_filter", True), ("exact_dedup", True), ("near_dedup", True), ("mix_sources", True), ("bpe_encode", False)]


def test_encode_has_ids(spark):
    from tokenizers import Tokenizer

    docs = spark.createDataFrame([(1, "the first text"), (2, ""), (3, "another one, the third")], "doc_id long, text string")
    tokenizer = Tokenizer.from_file(bpe_codec.default_path())
    got = {r.doc_id: r.ids for r in corpus_pipeline.encode(spark, docs, SF).collect()}
    assert got == {r.doc_id: tokenizer.encode(r.text, add_special_tokens=False).ids for r in docs.collect()}
