"""Line dedup, collocations and the Merkle manifest against plain versions and their SQL."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom.llm import collocations, linededup, merkle, queries
from seriesloom.llm.common import id_remainder
from tests.test_queries import rows as plain_rows

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
LOWER = {i: i + 32 for i in range(65, 91)}


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got, want = queries.queries()[name](spark, SF).toPandas(), con.execute(queries.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain_rows(got) == plain_rows(want)


# --- line dedup -------------------------------------------------------------------


def plain_lines(rows, min_chars, min_docs):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)

    def rank(doc):
        return doc is not None, doc or 0

    holders: dict = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(rank(doc))
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < min_docs or rank(doc) == max(holders[key(x)])]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize(("batch", "min_docs"), [("3", 2), ("3", 5), ("10000", 3)])
def test_lines_of_many_documents_go(spark, batch, min_docs):
    r = random.Random(min_docs)
    lines = [f"line number {k} of a text " for k in range(8)] + ["x", "", " Line Number 3 of a text", "\tÄ line with 20 code\r", *["a hot line that is everywhere"] * 9]
    rows = [(r.choice([None, k, k, 5]), None if r.random() < 0.1 else "\n".join(r.choice(lines) for _ in range(r.randint(0, 5)))) for k in range(300)]
    rows += [(7, "\n".join([*lines, "tail\n"] * 2000)), (8, "   "), (9, "\n"), rows[3], rows[3]]
    set_by = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.adaptive.coalescePartitions.enabled")
    for k, v in zip(set_by, (batch, "false"), strict=True):
        spark.conf.set(k, v)
    try:
        docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(c) for c in ("id", "line", "kept", "keep", "h1", "text_hash", "n_lines")})
        bitmaps = linededup.keep_bitmaps(docs.repartition(3), min_docs=min_docs)
        cut = linededup.apply(docs, bitmaps).select("doc.doc_id", "n_lines", "n_dropped", "kept").collect()
        assert sorted(map(tuple, cut), key=str) == plain_lines(rows, 20, min_docs)
        for b in bitmaps.collect():
            kept = linededup.kept_lines(bytes(b["keep"]), b["n_lines"])
            assert len(kept) == b["n_lines"] and b["n_lines"] - kept.sum() == b["n_dropped"]
        whole = linededup.remove(docs, min_docs=min_docs)
        assert whole.columns == docs.columns
        assert Counter((x["doc_id"], x["text"] or "") for x in whole.collect()) == Counter((x["doc_id"], x["kept"]) for x in cut)
        assert whole.filter("text IS NULL").count() == sum(t is None for _, t in rows)
    finally:
        for k in set_by:
            spark.conf.unset(k)


def test_no_lines(spark):
    assert linededup.remove(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# --- collocations -----------------------------------------------------------------


def plain_collocations(rows, min_count, max_words, top):
    counts: dict[str, Counter] = {}
    total: Counter = Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        found = counts.setdefault(lang, Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            total[lang] += len(w)
            found.update(tuple(w[i : i + k]) for k in range(1, max_words + 1) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        cands = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        covered = {d[i : i + k] for d, fd in cands.items() for k in range(2, len(d)) for i in range(len(d) - k + 1) if 100 * fd >= 80 * f[d[i : i + k]]}
        ranked = []
        for p, a in cands.items():
            if p not in covered:
                score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, n + 1, p.decode(), -a, left, right, total[lang], -s) for n, (s, a, p, left, right) in enumerate(sorted(ranked)[:top])]
    return sorted(out)


def phrase_rows(r):
    words = "the The of a b é ß in  \t x" .split() + ["un split", "%"]
    rows = [(r.choice(["en", "de", None, "und", "x" * 70]), "".join(r.choice(words) + r.choice([" ", "  ", "\t", ". ", ",", "\n", " ", " "]) for _ in range(r.randint(0, 40)))) for _ in range(250)]
    long = " ".join(r.choice(words) for _ in range(40_000))
    return [*rows, ("en", long), ("en", "w" * 300_000), ("en", None), ("en", ""), (None, " \t\n"), *rows[:20], ("zz", "rare words")]


@pytest.mark.parametrize(("modulus", "window", "buffer"), [(collocations.MERSENNE, 1 << 18, 4 << 20), (collocations.MERSENNE, 7, 500), (101, 5, 300)])
def test_phrases_are_counted_exactly(spark, monkeypatch, modulus, window, buffer):
    """A modulus of 101 makes most fingerprints collide; small windows and buffers cut phrases everywhere."""
    hashed = collocations._hashed

    def small(*args):
        run = hashed(*args)

        def inner(batches):
            collocations.WINDOW_WORDS, collocations.BUFFER_BYTES = window, buffer
            yield from run(batches)

        return inner

    monkeypatch.setattr(collocations, "_hashed", small)
    rows = phrase_rows(random.Random(5))
    docs = spark.createDataFrame(rows, "lang string, text string").withColumns({c: F.lit(c) for c in ("row", "fp", "count", "span", "phrase", "n")})
    got = collocations.collocations(docs.repartition(3), min_count=30, max_words=4, top=40, modulus=modulus).collect()
    assert sorted(map(tuple, got)) == plain_collocations(rows, 30, 4, 40)


def test_other_lengths_and_no_rows(spark):
    rows = phrase_rows(random.Random(6))[:200]
    docs = spark.createDataFrame(rows, "lang string, text string")
    for longest in (2, 3):
        got = collocations.collocations(docs, min_count=10, max_words=longest).collect()
        assert sorted(map(tuple, got)) == plain_collocations(rows, 10, longest, 2000)
    assert collocations.collocations(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        collocations.frequent_phrases(docs, max_words=1)


def test_fingerprints_are_those_of_the_polynomial():
    text = np.frombuffer(b"some bytes, and some bytes again" * 9, np.uint8)
    hasher = collocations.Fingerprints()
    spans = [(0, 10), (16, 26), (3, 3), (7, len(text))]
    got = hasher.of(hasher.prefixes(text), *(np.array(x) for x in zip(*spans, strict=True)))
    for (a, b), fp in zip(spans, got.tolist(), strict=True):
        parts = [sum((int(c) + 1) * pow(base, k, collocations.MERSENNE) for k, c in enumerate(text[a:b])) % collocations.MERSENNE for base in collocations.BASES]
        assert fp == parts[0] << 31 | parts[1]
    assert got[0] == got[1]


# --- Merkle manifest --------------------------------------------------------------


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_proofs(rows):
    def leaf(values):
        return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([digest("".join(out[-1][k : k + 16])) for k in range(0, len(out[-1]), 16)])
        return out

    def path(tree, at):
        for nodes in tree[:-1]:
            run = nodes[at // 16 * 16 :][:16]
            yield "".join(run[: at % 16]), "".join(run[at % 16 + 1 :])
            at //= 16

    groups: dict = {}
    for doc, source, lang, n, text in rows:
        changed = zlib.crc32(str("" if doc is None else doc).encode()) % 5 == 0 and text is not None
        given = leaf((doc, source, lang, n, text.translate(LOWER) if changed else text))
        groups.setdefault(source, []).append((doc is not None, doc or 0, leaf((doc, source, lang, n, text)), given, doc))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in names}
    top = levels([trees[s][-1][0] for s in names])
    out = []
    for j, s in enumerate(names):
        for k, x in enumerate(sorted(groups[s], key=lambda x: x[:3])):
            siblings, folded = "", x[3]
            for left, right in [*path(trees[s], k), *path(top, j)]:
                siblings, folded = siblings + left + right, digest(left + folded + right)
            out.append((x[4], x[2], trees[s][-1][0], top[-1][0], digest(siblings), folded, folded == top[-1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize(("rows", "sources", "chunk"), [(0, 1, 4096), (1, 1, 4096), (40, 40, 2), (600, 3, 2)])
def test_proofs_fold_to_the_root(spark, monkeypatch, rows, sources, chunk):
    monkeypatch.setattr(merkle, "CHUNK", chunk)
    r = random.Random(rows)
    made = [(r.choice([None, k, k, k, 5]), r.choice([None, "", *[f"s{j}é" for j in range(sources)]]), r.choice([None, "en"]), 3, r.choice([None, "", "Ab", "lower", "É", "LONG " * 50_000])) for k in range(rows)]
    made += made[:5]
    docs = spark.createDataFrame(made, "doc_id long, source string, lang string, n_chars long, text string").withColumns({c: F.lit(c) for c in ("id", "tree", "digest", "pos", "root")})
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    text = F.when(id_remainder("doc_id", 5) == 0, merkle.lower_ascii(F.col("text"))).otherwise(F.col("text"))
    got = merkle.proofs(docs.repartition(3), columns=columns, tampered=merkle.leaf([*(F.col(c) for c in columns[:-1]), text]))
    got = got.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")), "folded_root", "verified")
    assert sorted(map(tuple, got.collect()), key=str) == plain_proofs(made)
    whole = merkle.proofs(docs, columns=columns)
    assert whole.filter("NOT verified").count() == 0 and whole.count() == len(made)
