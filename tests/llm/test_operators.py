"""Each operator against a plain version on small inputs, with nulls, empty and long texts, ties, repeats and extra columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seriesloom.llm import chat, chat_template, decontam, embdedup, langid, lattice, lm, near_duplicates, packing, pii, simhash, subdedup, toxicity
from seriesloom.llm.common import id_remainder
from seriesloom.llm.components import connected_components

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = "the and of to in is that ertion thnd heble eau ment über straße ción niño x1 %% THE".split()


def sentence(r, n):
    return " ".join(r.choice(WORDS) for _ in range(n))


def documents(spark, rows):
    """With a null id, and columns whose names operators use inside."""
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(c) for c in ("id", "fp", "words", "part", "n")})


def odd_rows(r):
    rows = [(k, sentence(r, r.randint(1, 60))) for k in range(40)]
    long = sentence(r, 30_000)
    return rows + [(100, None), (101, ""), (102, "  \n "), (103, long), (104, rows[0][1]), (105, rows[0][1]), (0, rows[0][1]), (None, rows[1][1]), (None, "alone here"), (106, "<|endoftext|> a " + " " * 50)]


# --- packing --------------------------------------------------------------------


def test_packing_is_a_whole_gapless_cut(spark):
    rows = odd_rows(random.Random(1))
    got = packing.pack(documents(spark, rows).repartition(3), JSON, RANKS, seq_len=64).collect()
    tokenizer = Tokenizer.from_file(JSON)
    pieces: dict = {}
    for p in got:
        ids = np.frombuffer(bytes(p["ids"]), "<u4").tolist()
        assert len(ids) == p["length"] and 0 <= p["offset"] and p["offset"] + p["length"] <= 64
        pieces.setdefault((p["doc_id"], p["doc_tokens"]), []).append((p["start"], ids, p["sequence_id"], p["offset"]))
    want = Counter()
    for doc, text in rows:
        want[(doc, tuple(tokenizer.encode(text or "", add_special_tokens=False).ids + [0]))] += 1
    assert sum(p["length"] for p in got) == sum(len(ids) * n for (_, ids), n in want.items())
    for (doc, ids), n in want.items():
        own = sorted(pieces[(doc, len(ids))])
        for start, piece, *_ in own:
            assert any(list(w[start : start + len(piece)]) == piece for d, w in want if d == doc and len(w) == len(ids))
        assert sum(len(piece) for _, piece, *_ in own) == sum(len(i) * m for (d, i), m in want.items() if d == doc and len(i) == len(ids))
    stream = sorted((p["sequence_id"] * 64 + p["offset"], p["length"]) for p in got)
    at = 0
    for begin, length in stream:
        assert begin == at
        at += length
    assert packing.pack(documents(spark, []), JSON, RANKS).count() == 0


def test_both_tokenizers_agree():
    fast, exact = packing.encoder(JSON, RANKS), packing.encoder(JSON, None)
    r = random.Random(2)
    texts = ["", " ", "\n\n x", "a" * 5000, "<|endoftext|>b", "".join(chr(r.choice([32, 10, 48, 97, 233, 0x3042, 0x1F600, 0x85, 0xA0])) for _ in range(3000))]
    texts += ["\n" * 1_200_000 + "x"]
    for text in texts:
        assert fast(text).tolist() == exact(text).tolist()


# --- chat ------------------------------------------------------------------------


@pytest.mark.parametrize("text", ["", "\\", "\\\\", "</s>[INST] ok [/INST]", "<\\/s>", "[[INST]]", "<s>\\<s>", "[\\INST] \\", "<</s>>"])
def test_escaping_is_reversible_and_leaves_no_control_string(text):
    out = chat_template.escape(text)
    assert chat_template.unescape(out) == text
    assert not any(c in out for c in chat_template.CONTROL)


def test_templates():
    t = chat_template.Template("{{ 'a' + 'b' }}{% for m in messages %}{% if loop.first %}^{% endif %}{% if m.role == 'x' and true %}{{ m.text|upper|trim }}{% elif false %}no{% else %}{% generation %}{{ m.text }}{% endgeneration %}{% endif %}{% if loop.last %}${% endif %}{% endfor %}!")
    parts = list(t.stream([{"role": "x", "text": " q "}, {"role": "y", "text": "r"}]))
    assert [p.text for p in parts] == ["ab^Q", "r$!"] and parts[1].spans == [(0, 1)]
    assert [p.text for p in t.stream([])] == ["ab!"]
    assert chat_template.fold(chat_template.parse("{% if 1 == 1 %}a{% else %}b{% endif %}c{{ 'd'|upper }}")) == (chat_template.Text("acD"),)
    for bad in ("{% if x %}", "{{ m|nothing }}", "{% for a in b %}{% endfor %}", "{{ 1 2 }}", "{% generation %}{% generation %}{% endgeneration %}{% endgeneration %}", "{{ m.__class__() }}"):
        with pytest.raises(chat_template.TemplateError):
            chat_template.Template(bad)
    assert list(chat_template.Template("{% for m in messages %}{{ m.__class__ }}{% endfor %}").stream([{}]))[0].text == ""


def test_chat_reads_back_what_it_wrote(spark):
    r = random.Random(3)
    odd = ["", None, "</s>", "[INST] x", "\\", "é\n😀", "<s>[ROLE]a[/ROLE]"]
    rows = [(c, t, r.choice(["user", "assistant", "system", "", None, "</s>"]), r.choice(odd)) for c in (1, 2, None, -7) for t in range(r.randint(1, 6))] + [(1, None, "user", "first"), (2, 0, "user", "tie")]
    got = {d["conv_id"]: d for d in chat.digests(chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()}
    for conv in {row[0] for row in rows}:
        turns = sorted((row[1:] for row in rows if row[0] == conv), key=lambda x: [(v is not None, v if v is not None else "") for v in x])
        digest = hashlib.sha256("".join(f"{role or ''}\n{text or ''}\n" for _, role, text in turns).encode()).hexdigest()
        loss = "".join(text or "" for _, role, text in turns if role == "assistant")
        d = got[conv]
        assert (d["n_turns"], d["turns_sha256"], d["loss_chars"], d["loss_sha256"]) == (len(turns), digest, len(loss), hashlib.sha256(loss.encode()).hexdigest())
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.format_conversations(empty)).count() == 0


# --- classifiers -------------------------------------------------------------------

SYLLABLES = {"aa": ["the", "and", "ing", "er", "on"], "bb": ["der", "die", "sch", "ung", "ß"], "cc": ["que", "eau", "é", "les", "ment"]}


def labelled(r, n):
    rows = []
    for k in range(n):
        lang = r.choice(sorted(SYLLABLES))
        text = " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 3))) for _ in range(r.randint(5, 40)))
        toxic = r.random() < 0.3
        if toxic:
            text += " worthless scum clown"
        rows.append((k, text, lang, int(toxic)))
    return rows


@pytest.mark.parametrize(("text", "letter"), [("½ ²", False), ("①②", False), ("Ⅷ 12", False), ("٣ 7_", False), ("", False), ("1 é", True), ("あ", True), ("ª", True)])
def test_only_letters_have_a_language(text, letter):
    assert langid.has_letter(text) is letter


def test_language_and_toxicity_are_learnt(spark):
    rows = labelled(random.Random(4), 700)
    docs = spark.createDataFrame(rows + [(9000, None, "aa", None), (9001, "12 !!", None, None), (9002, "", None, None)], "doc_id long, text string, lang string, toxic int")
    held = id_remainder("doc_id", 4) == 2
    got = {r["doc_id"]: r for r in langid.identify(docs, ~held).collect()}
    out = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert sum(got[k]["lang_pred"] == lang for k, _, lang, _ in out) > 0.95 * len(out)
    assert {got[k]["lang_pred"] for k in (9000, 9001, 9002)} == {"und"} and all(0 <= r["score"] <= 1 for r in got.values())
    labels = spark.createDataFrame([(k, t) for k, _, _, t in rows] + [(1, None), (None, 1)], "doc_id long, toxic int").filter(id_remainder("doc_id", 5) != 0)
    model = toxicity.train(docs, labels)
    scored = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    out = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert sum((scored[k] >= 0.5) == bool(t) for k, _, _, t in out) > 0.95 * len(out)
    kept = toxicity.keep_below(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(v < 0.5 for v in scored.values())
    assert langid.identify(docs.limit(0), F.lit(True)).count() == 0
    assert {r["lang_pred"] for r in langid.identify(docs.withColumn("lang", F.lit(None).cast("string")), F.lit(True)).collect()} == {"und"}
    assert max(r["score"] for r in toxicity.score(docs, toxicity.train(docs, labels.limit(0))).collect()) < 0.01


# --- deduplication ------------------------------------------------------------------


def components(ids, linked):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def test_components(spark):
    r = random.Random(5)
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, 100), (None, 1), (200, 205), (205, 199)] + [(300, 300 + r.randint(1, 40)) for _ in range(30)]
    got = {x["node"]: x["component"] for x in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    assert got == components({x for e in real for x in e}, real)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_fingerprint(text, n=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[k : k + n]), seed=42) for k in range(max(1, len(w) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    near = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2]
    root = components(range(len(fps)), near)
    first = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            first[root[k]] = min(doc, first.get(root[k], doc))
    return [(doc, fps[k], first.get(root[k])) for k, (doc, _) in enumerate(rows)]


def near_copies(r, n, words):
    base = [r.choice(WORDS) + str(r.randint(0, 99)) for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        w[r.randrange(words)] = "z" + str(r.randint(0, 9999))
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("paired", [48, 2])
def test_simhash_groups(spark, monkeypatch, paired):
    monkeypatch.setattr(simhash, "PAIRED", paired)  # 2: nearly all go the way of full buckets
    r = random.Random(6)
    rows = odd_rows(r)
    rows += [(1000 + k, t) for k, t in enumerate(near_copies(r, 150, 400) + near_copies(r, 40, 60))]
    docs = documents(spark, rows)
    got = sorted(((x["doc_id"], x["fp"] & (1 << 64) - 1, x["component_id"]) for x in simhash.group(docs).collect()), key=str)
    want = plain_groups(rows)
    assert got == sorted(want, key=str)
    assert len({c for *_, c in want}) < len(rows) - 60
    kept = near_duplicates.deduplicate(docs, shingle_words=3, similarity=None)
    assert kept.columns == docs.columns
    ids = [x["doc_id"] for x in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({c for *_, c in want if c is not None})
    assert ids.count(None) == len({f for d, f, c in want if c is None})
    assert simhash.group(documents(spark, [])).count() == 0


def test_pigeonring_links_are_all_links(spark):
    r = random.Random(7)
    fps = set()
    for _ in range(60):
        x = r.getrandbits(64)
        fps |= {x} | {x ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for _ in range(4)}
    signed = [x - (1 << 64) * (x >> 63) for x in fps]
    got = {(x["a"], x["b"]) for x in simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()}
    mask = (1 << 64) - 1
    assert got == {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & mask).bit_count() <= 2}


def plain_kept(rows, shingle_words=5, similarity=0.8):
    """What stays of (id, text) rows by comparing all pairs of texts: fingerprints at 2 bits, or exact Jaccard similarity."""
    texts = sorted({t or "" for _, t in rows})
    words = [re.findall("[^ \\t-\\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) for t in texts]
    sets = [{" ".join(w[k : k + shingle_words]) for k in range(max(1, len(w) - shingle_words + 1))} if w else set() for w in words]
    fps = [simhash.fingerprint(t, shingle_words) for t in texts]
    root = list(range(len(texts)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            alike = (fps[a] ^ fps[b]).bit_count() <= 2 or len(sets[a] & sets[b]) >= similarity * max(1, len(sets[a] | sets[b]))
            if alike and top(a) != top(b):
                root[top(a)] = top(b)
    groups = {}
    for doc, text in rows:
        groups.setdefault(top(texts.index(text or "")), []).append((doc is None, doc))
    return sorted(min(g, key=lambda x: (x[0], x[1] or 0)) for g in groups.values())


def edited(r, base, share):
    """A copy with this share of its words changed."""
    return " ".join("v" + str(r.random()) if r.random() < share else w for w in base)


@pytest.mark.parametrize(("leaders", "chunk", "few"), [(2, 1024, 1 << 20), (1, 7, 0)])
def test_near_duplicates_are_those_of_all_pairs(spark, monkeypatch, leaders, chunk, few):
    """Single copies, chains, and a large group around one text whose copies are often unlike each other."""
    monkeypatch.setattr(near_duplicates, "LEADERS", leaders)
    monkeypatch.setattr(near_duplicates, "CHUNK", chunk)  # 7: most buckets are dealt to several tasks
    monkeypatch.setattr(near_duplicates, "BROADCAST_ROWS", few)
    r = random.Random(16)
    rows = [(k, " ".join(f"w{r.random()}" for _ in range(80))) for k in range(30)]
    for g in range(12):
        base = [f"g{g}x{j}" for j in range(300)]
        for k in range(60 if g == 0 else 3):
            rows.append((1000 * (g + 1) + r.randrange(900), edited(r, base, r.choice([0.005, 0.02, 0.04]))))
    shared = [f"s{j}" for j in range(200)]
    for k in range(25):  # texts that share a passage and no more: alike in some buckets, no duplicates
        rows.append((20_000 + k, " ".join(shared + [f"o{r.random()}" for _ in range(80)])))
    rows += [(400, None), (401, ""), (402, rows[0][1]), (403, rows[0][1].upper() + "  "), (None, rows[1][1]), (None, "one of its own"), (None, "one of its own"), (5, rows[5][1])]
    docs = documents(spark, rows).withColumns({c: F.lit(k) for k, c in enumerate(("_fp", "_root", "_sig", "_cls", "_hash", "_id", "_copies", "row", "doc", "place", "digest", "bands", "key", "comp", "cls", "h1", "h2", "same", "first"))})
    got = near_duplicates.deduplicate(docs)
    assert got.columns == docs.columns
    found = sorted(((x["doc_id"] is None, x["doc_id"]) for x in got.collect()), key=lambda x: (x[0], x[1] or 0))
    assert found == sorted(plain_kept(rows), key=lambda x: (x[0], x[1] or 0))
    assert near_duplicates.deduplicate(documents(spark, [])).count() == 0


def test_a_bucket_of_unlike_texts_is_dealt_in_bounded_lots(spark, monkeypatch):
    """5,000 texts share one bucket; only ten pairs are alike."""
    n, seen = 5000, []
    real = near_duplicates.dealt

    def watched(rows):
        out = real(rows).cache()
        seen.append(out.groupBy("key", "lot", "chunk").agg(F.count_if("lead").alias("leaders"), F.count_if(~F.col("lead")).alias("members")).collect())
        return out

    monkeypatch.setattr(near_duplicates, "dealt", watched)
    r = random.Random(29)
    own = [sorted(r.sample(range(1 << 30), 20)) for _ in range(n)]
    for k in range(10):
        own[4000 + k] = sorted({*own[k][:19], 7 + k})  # 19 of 21
    sets = spark.createDataFrame(list(enumerate(own)), "cls long, shingles array<int>").cache()
    labels = sets.select("cls", F.col("cls").alias("comp"))
    bands = sets.select("cls", F.array(F.lit(5).cast("long")).alias("bands"))
    got = {x["cls"]: x["comp"] for x in near_duplicates.similar_groups(bands, labels, lambda needed: sets.join(needed, "cls"), 0.8).collect()}
    assert got == {k: k - 4000 if 4000 <= k < 4010 else k for k in range(n)}
    assert len(seen[-1]) == 20  # those who haven't led in the rounds before, in four lots, meet five chunks of members
    assert max(x["leaders"] for tasks in seen for x in tasks) < 1.25 * near_duplicates.CHUNK
    assert max(x["members"] for tasks in seen for x in tasks) < 1.25 * near_duplicates.CHUNK


def test_bands_find_what_is_similar():
    """The share of pairs at the least similarity that meet in a bucket."""
    r, met, n = random.Random(5), 0, 0
    for _ in range(600):
        base = np.array([r.getrandbits(64) for _ in range(180)], np.uint64)
        other = np.concatenate([base[:160], np.array([r.getrandbits(64) for _ in range(20)], np.uint64)])  # Jaccard 0.8
        met += bool(set(near_duplicates.band_keys(base).tolist()) & set(near_duplicates.band_keys(other).tolist()))
        n += 1
    assert met / n >= 0.98


@pytest.mark.parametrize("similarity", [None, 0.8])
def test_an_id_on_different_texts_stays_in_each_group(spark, similarity):
    r = random.Random(22)
    text = [" ".join(f"w{r.random()}" for _ in range(60)) for _ in range(8)]
    # 7 names the groups of six texts; the group of text[6] is named by 3, that of text[7] has no id.
    rows = [(7, t) for t in text] + [(9, text[0]), (9, text[1]), (3, text[6]), (7, text[2]), (None, text[3]), (None, text[7] + " more")]
    rows = [(None, t) if (k, t) == (7, text[7]) else (k, t) for k, t in rows]
    got = sorted((x["doc_id"] or 0, x["text"]) for x in near_duplicates.deduplicate(documents(spark, rows), shingle_words=5, similarity=similarity).collect())
    groups = [(7, t) for t in text[:6]] + [(3, text[6])]
    assert [x for x in got if x[0]] == sorted(groups)
    assert {t for k, t in got if not k} & {text[7], text[7] + " more"}


def plain_repeats(rows, least):
    """(id, text) to its spans: later occurrences of units, in runs of at least so many words."""
    earliest, out = {}, {}
    docs = sorted({x for x in rows if x[1]}, key=lambda x: (x[0] is None, x[0] or 0))
    for at, (doc, text) in enumerate(docs):
        run = []
        for k, (start, end, plain) in enumerate([*subdedup.units(text), (0, 0, "")]):
            if plain and earliest.setdefault(plain, (at, k)) != (at, k):
                run.append((start, end, len(plain.split())))
                continue
            if sum(n for *_, n in run) >= least:
                out.setdefault((doc, text), []).append((run[0][0], run[-1][1]))
            run = []
    return out


def test_repeated_passages(spark):
    r = random.Random(8)
    passage = ". ".join("Word" + str(r.random()) + " " + sentence(r, 14) for _ in range(5)) + "."
    rows = [(k, ". ".join(sentence(r, 9) + str(r.random()) for _ in range(6)) + ".\n" + "Short common line.") for k in range(20)]
    rows += [(50 + k, f"Own {k} start {r.random()}. {passage} And own end {r.random()}.") for k in range(4)] + [(60, passage), (60, passage), (61, None), (62, ""), (None, passage), (63, passage.upper().replace(" ", "  "))]
    rows += [(70 + k, f"Clipped, {passage[40 * k : -30]}") for k in range(3)] + [(80, sentence(r, 40_000))]
    docs = documents(spark, rows).withColumns({c: F.lit(c) for c in ("doc", "hash", "spans", "unit")})
    got = subdedup.repeated(docs).collect()
    assert {x["doc_id"] for x in got} == {51, 52, 53, 60, None, 63, 70, 71, 72}
    for least in (25, 1):
        want = plain_repeats(rows, least)
        found = {(x["doc_id"], x["start"], x["end"]) for x in subdedup.repeated(docs, min_words=least).collect()}
        assert found == {(doc, s, e) for (doc, _), spans in want.items() for s, e in spans}
        removed = subdedup.remove(docs, min_words=least)
        assert removed.columns == docs.columns
        cut = sorted(((x["doc_id"], x["text"]) for x in removed.collect()), key=str)
        assert cut == sorted(((doc, subdedup.cut_spans(t, want.get((doc, t), [])) if t else t) for doc, t in rows), key=str)
    by_id = dict(rows)
    for x in got:
        assert x["first_id"] == 50 and "Word" in by_id[x["doc_id"]][x["start"] : x["end"]] or x["doc_id"] == 63
    assert subdedup.cut_spans("a\nbb\nc", [(2, 4)]) == "a\nc"
    assert subdedup.repeated(documents(spark, [])).count() == 0


def test_units_cover_the_text():
    for text in ("", " \n\n", "a. b! c?\n d 3.14 x.", "...", "one\n two. ", "é." * 50, "x" * 10_000):
        spans = [(s, e) for s, e, _ in subdedup.units(text)]
        assert spans == sorted(spans) and all(s < e for s, e in spans)
        left = list(text)
        for s, e in spans:
            left[s:e] = " " * (e - s)
        assert not re.search(r"[^\W_]", "".join(left))


def test_embeddings(spark):
    r = np.random.default_rng(9)
    base = r.standard_normal((60, 16))
    v = np.concatenate([base, base[:10] + 0.1 * r.standard_normal((10, 16)), np.repeat(base[:1], 30, axis=0), base[1] + 0.05 * r.standard_normal((40, 16))])
    rows = [(int(k), [float(np.float32(x)) for x in row]) for k, row in enumerate(v)]
    rows += [(500, None), (501, [0.0] * 16), (502, [float("nan")] + [1.0] * 15), (503, [None] + [1.0] * 15), (504, [1.0, 2.0]), (505, [2.0, 4.0]), (506, []), (None, rows[2][1]), (2, rows[2][1])]
    got = embdedup.group(spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit(1)), least=0.9).collect()

    def unit(x):
        x = np.array(x, float)
        return x / np.linalg.norm(x)

    ok = [k for k, (_, x) in enumerate(rows) if x and all(c is not None and math.isfinite(c) for c in x) and any(x)]
    near = [(i, j) for i in ok for j in ok if i < j and len(rows[i][1]) == len(rows[j][1]) and unit(rows[i][1]) @ unit(rows[j][1]) >= 0.9]
    root = components(range(len(rows)), near)
    links = Counter(k for e in near for k in e)
    first = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            first[root[k]] = min(i, first.get(root[k], i))
    want = Counter((rows[k][0], links[k], first.get(root[k])) for k in range(len(rows)))
    have = Counter((x["vec_id"], x["n_links"], x["component_id"]) for x in got)
    assert sum((want & have).values()) >= 0.97 * len(rows)
    assert sum(x["n_links"] for x in got) >= 0.98 * 2 * len(near)
    assert embdedup.group(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


@pytest.mark.parametrize("buckets", [0, 1 << 17])
def test_embedding_blocks_lose_nothing(spark, monkeypatch, buckets):
    """With bucket sizes broadcast, and looked up."""
    monkeypatch.setattr(embdedup, "BLOCK", 7)
    monkeypatch.setattr(embdedup, "BROADCAST_BUCKETS", buckets)
    r = np.random.default_rng(10)
    v = r.standard_normal(8) + 0.02 * r.standard_normal((60, 8))
    got = embdedup.group(spark.createDataFrame([(k, [float(x) for x in row]) for k, row in enumerate(v)], "vec_id long, embedding array<double>")).collect()
    assert {x["n_links"] for x in got} == {59} and {x["component_id"] for x in got} == {0}


def test_classifiers_answer_every_row_alike(spark):
    """Repeated rows, clashing column names and a very long text."""
    rows = labelled(random.Random(14), 300)
    long = rows[0][1] + " " + " ".join(rows[k % 300][1] for k in range(3000))
    docs = spark.createDataFrame([*rows, rows[1], rows[1], (7000, long, rows[0][2], 0)], "doc_id long, text string, lang string, toxic int").withColumns({c: F.lit(c) for c in ("id", "label", "score", "hash", "n")})
    named = langid.identify(docs, F.col("doc_id") < 7000).collect()
    model = toxicity.train(docs, docs.select("doc_id", "toxic").distinct())
    scored = toxicity.score(docs, model).collect()
    for got, answer in ((named, "lang_pred"), (scored, "score")):
        assert Counter(x["doc_id"] for x in got) == Counter([*(k for k, *_ in rows), 1, 1, 7000])
        assert len({x[answer] for x in got if x["doc_id"] == 1}) == 1
    assert all(0 <= x["score"] <= 1 for x in scored)


# --- language model --------------------------------------------------------------------


def plain_marginal(word, pieces, logp):
    text, names = lattice.WORD_START + word, {n: k for k, n in enumerate(pieces.names)}
    total = [1.0] + [0.0] * len(text)
    for t in range(1, len(text) + 1):
        total[t] = sum(total[k] * math.exp(logp[names[text[k:t]]]) for k in range(t) if text[k:t] in names)
        if text[t - 1] not in names:
            total[t] += total[t - 1] * math.exp(sum(logp[len(pieces.names) + b] for b in text[t - 1].encode()))
    return math.log10(total[-1])


def test_lattice_sums_over_all_segmentations():
    pieces, logp = lattice.existing_pieces(PIECES)
    words = ["the", "a", "", "erheble", "日本", "x" * 60, "naïve", "\U0001f600"]
    got = lattice.log10_marginals(words, pieces, logp)
    assert got == pytest.approx([plain_marginal(w, pieces, logp) for w in words], abs=1e-9)
    counts = lattice.expected_counts(["the", "therethe"], np.array([3.0, 1.0]), pieces, logp)
    spelled = sum(len(n) * c for n, c in zip(pieces.names, counts, strict=False))
    assert spelled == pytest.approx(3 * 4 + 9)  # each segmentation spells the whole word


def test_lm_base_scores_and_gain(spark):
    r = random.Random(11)
    rows = [(k, sentence(r, r.randint(1, 50)), r.choice(["aa", "bb", None])) for k in range(120)] + [(900, None, "aa"), (901, "", None), (902, "newword " * 40, "aa"), (None, "the", "aa")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("key", F.lit(1))
    got = lm.score(docs, id_remainder("doc_id", 10) != 0, PIECES).collect()
    train = [t or "" for k, t, _ in rows if zlib.crc32(("" if k is None else str(k)).encode()) % 10]
    counts = Counter(w for t in train for w in t.encode().lower().split())
    n = sum(counts.values()) + len(train)
    size = n + 0.1 * (len(counts) + 2)
    want = Counter()
    for k, t, _ in rows:
        words = (t or "").encode().lower().split()
        base = sum(math.log10((counts[w] + 0.1) / size) for w in words) + math.log10((len(train) + 0.1) / size)
        want[(k, len(words) + 1, sum(counts[w] > 0 for w in words) + 1, n, round(base, 6))] += 1
    assert Counter((x["doc_id"], x["n_tokens"], x["n_known"], x["train_tokens"], round(x["base_score"], 6)) for x in got) == want
    assert all(math.isfinite(x["score"]) and x["score"] < 0 for x in got)
    repeated = next(x for x in got if x["doc_id"] == 902)
    assert repeated["score"] > repeated["base_score"]
    assert lm.score(docs.limit(0), F.lit(True), PIECES).count() == 0
    assert lm.score(docs, F.lit(False), PIECES).filter("train_tokens = 0 AND score < 0").count() == len(rows)


def test_lm_long_unknown_words_keep_their_log_probability(spark):
    r = random.Random(21)
    train = [(k, " ".join(r.choice(WORDS[:12]) for _ in range(30))) for k in range(20)]
    long = ["".join(r.choice("abcdefgh") for _ in range(5000)), "\u4e9c\u05d0" * 400]
    held_out = [(100, long[0]), (101, f"{long[1]} {long[1]} {long[1]} the"), (102, " ".join([long[0]] * 60))]
    docs = documents(spark, train + held_out)
    got = {x["doc_id"]: x["score"] for x in lm.score(docs, F.col("doc_id") < 100, PIECES, class_col=None).collect()}

    counts = Counter(w for _, t in train for w in t.lower().split())
    known = spark.createDataFrame([(w,) for w in counts], "word string")
    pieces, start = lattice.existing_pieces(PIECES)
    logp, names = lm._fit_pieces(known, pieces, start), {n: k for k, n in enumerate(pieces.names)}
    widest = max(map(len, names))
    tokens, types = sum(counts.values()) + len(train), len(counts) + 1
    once, twice = (sum(c == k for c in counts.values()) for k in (1, 2))
    discount = once / (once + 2 * twice) if once else 0.5

    def log_sum(ways):
        return max(ways) + math.log(sum(math.exp(x - max(ways)) for x in ways))

    def log_p(word):
        text = lattice.WORD_START + word
        total = [0.0]
        for t in range(1, len(text) + 1):
            ways = [total[k] + logp[names[text[k:t]]] for k in range(max(0, t - widest), t) if text[k:t] in names]
            if text[t - 1] not in names:
                ways.append(total[t - 1] + sum(logp[len(names) + b] for b in text[t - 1].encode()))
            total.append(log_sum(ways))
        below = total[-1]
        for _ in range(2):  # the corpus, then its one class
            below += math.log(discount * types / tokens)
            if word in counts:
                below = log_sum([below, math.log((counts[word] - discount) / tokens)])
        return below

    for k, text in held_out:
        found = Counter(text.split())
        # The words and the end, which is the last draw, come out of one urn.
        want = math.log(lm.STRENGTH) + math.log((len(train) - discount) / tokens) - sum(math.log(lm.STRENGTH + j) for j in range(sum(found.values()) + 1))
        for w, n in found.items():
            x = log_p(w) + math.log(lm.STRENGTH)
            want += x + sum(math.log(math.exp(x) + j) for j in range(1, n))
        assert got[k] == pytest.approx(want / math.log(10), rel=1e-9)
        assert got[k] < -1000


def test_lm_gives_all_texts_a_probability_of_one_at_most(spark):
    """All texts of one known word up to a length: their probabilities rise towards what is left after unknown words."""
    train = [(-1 - k, "word " * 300) for k in range(30)]
    every = [(n, "word " * n) for n in range(1500)]
    docs = documents(spark, train + every)
    got = {x["doc_id"]: x["score"] for x in lm.score(docs, F.col("doc_id") < 0, PIECES, class_col=None).collect()}
    sums = np.cumsum([10.0 ** got[n] for n in range(1500)])
    assert 0.9 < sums[-1] <= 1 and sums[299] < 0.8


# --- decontamination ---------------------------------------------------------------------


def plain_distance(window, text):
    row = [0] * (len(text) + 1)
    for a in window:
        new = [row[0] + 1]
        for k, b in enumerate(text):
            new.append(min(row[k] + (a != b), row[k + 1] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_banded_alignment_is_exact():
    r = random.Random(12)
    for _ in range(80):
        w = [r.randrange(6) for _ in range(30)]
        x = list(w)
        for _ in range(r.randint(0, 4)):
            k, how = r.randrange(len(x)), r.randrange(3)
            x[k : k + 1] = [[9], [9, x[k]], []][how]
        pre, post = ([r.randrange(6) for _ in range(r.randrange(15))] for _ in range(2))
        got = decontam.banded_distance(np.array(w), np.array(pre + x + post), len(pre), 8, 6)
        want = plain_distance(w, pre + x + post)
        assert (got[0] if got else None) == (want if want <= 6 else None)


def test_decontamination(spark):
    r = random.Random(13)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(k, text(30)) for k in range(12)] + [(50, "short"), (51, None), (52, "")]
    clean = [(k, text(r.randint(1, 200))) for k in range(30)] + [(80, None), (81, "")]
    leaks = []
    for k in range(12):
        leaked = items[k][1]
        if k % 3 == 1:
            leaked = leaked.upper().replace(" ", ",\n ")
        if k % 3 == 2:
            at = len(leaked) // 2
            leaked = leaked[:at] + "qq" + leaked[at + 1 :]
        leaks.append((200 + k, f"{text(40)} {leaked} {text(3000 if k == 0 else 5)}"))
    leaks.append((None, items[3][1]))
    docs, benchmark = documents(spark, clean + leaks), spark.createDataFrame(items, "item_id long, text string")
    got = decontam.find(docs, benchmark).collect()
    assert {(x["doc_id"], x["item_id"]) for x in got} == {(200 + k, k) for k in range(12)} | {(None, 3)}
    exact = next(x for x in got if x["doc_id"] == 200)
    assert dict(leaks)[200][exact["start"] : exact["end"]] in items[0][1]
    kept = decontam.remove(docs, benchmark)
    assert kept.columns == docs.columns and {x["doc_id"] for x in kept.collect()} == {k for k, _ in clean}
    assert decontam.find(docs, benchmark.limit(0)).count() == 0 and decontam.remove(docs, benchmark.limit(0)).count() == docs.count()


def best_stretch(window, text):
    """The least edit distance of the whole window to any stretch of the text."""
    cost = np.zeros(len(text) + 1, np.int64)
    for k, letter in enumerate(window):
        step = np.empty_like(cost)
        step[0] = k + 1
        step[1:] = np.minimum(cost[:-1] + (text != letter), cost[1:] + 1)
        cost = np.minimum.accumulate(step - np.arange(len(step))) + np.arange(len(step))
    return int(cost.min())


def test_decontamination_finds_the_whole_budget():
    """Every window whose best alignment is within the budget, by comparing all windows with all texts."""
    r = random.Random(23)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 9)))
    items = [(k, " ".join(word() for _ in range(60))[: r.choice([16, 20, 25, 30, 40, 50, 60, 80, 99, 100, 180])].strip() + "x") for k in range(40)]
    index = decontam.build_index(items)
    assert all(decontam.bound(n) >= min(decontam.SHARED, n / 3) for n in range(decontam.MIN_CHARS, 101))
    hits = misses = 0
    for k, (_, item) in enumerate(items * 4):
        copy, edits = list(item), r.randint(0, int(len(item) * 0.1) + 1)
        for _ in range(edits):
            at = r.randrange(len(copy))
            copy[at : at + 1] = r.choice([[], ["q"], [copy[at], "r"]])
        text = " ".join(word() for _ in range(12)) + " " + "".join(copy) + " " + " ".join(word() for _ in range(12))
        points = decontam.normalised(text)[0]
        got = {x[0] for x in decontam.find_regions(text, index)}
        want = {i for i, w in index.windows if best_stretch(w, points) <= decontam.budget(len(w))}
        assert got == want, (k, item, text)
        hits, misses = hits + bool(want), misses + (not want)
    assert hits > 60 and misses > 10


def test_decontamination_of_short_items_and_no_documents(spark):
    benchmark = spark.createDataFrame([(1, "Yes, it is."), (2, "a much longer item that is searched inside of texts, word by word")], "item_id long, text string")
    docs = documents(spark, [(1, "yes IT is"), (2, "well, yes it is so"), (3, ""), (4, None)])
    assert {(x["doc_id"], x["item_id"]) for x in decontam.find(docs, benchmark).collect()} == {(1, 1)}
    assert decontam.find(docs.limit(0), benchmark).count() == 0 and decontam.remove(docs.limit(0), benchmark).count() == 0


def test_decontamination_by_a_large_benchmark_gives_the_same_rows(spark, monkeypatch):
    r = random.Random(29)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 9)))
    items = [(k, " ".join(word() for _ in range(60))[: r.choice([17, 25, 40, 60, 99, 100, 180, 300])].strip() + "x") for k in range(60)]
    items += [(70, items[5][1]), items[7], (8, items[8][1] + " and more"), (71, "Yes, it is."), (72, None), (73, ""), (None, items[6][1])]
    docs = [(900, None), (901, ""), (902, "yes IT is"), (903, "well, yes it is so"), (904, "yes it is"), (904, "yes it is")]
    for k in range(150):
        copy = list(items[k % 60][1])
        for _ in range(r.randint(0, int(len(copy) * 0.09) + 1)):
            at = r.randrange(len(copy))
            copy[at : at + 1] = r.choice([[], ["q"], [copy[at], "r"]])
        around = [" ".join(word() for _ in range(r.choice([0, 5, 200]))) for _ in range(2)]
        docs.append((k, f"{around[0]}  {''.join(copy)}; {around[1]}" + (" " + items[(k * 7) % 60][1] if k % 4 == 0 else "")))
    docs += [docs[10], docs[10], (10, "another text with the same id")]
    table, benchmark = documents(spark, docs), spark.createDataFrame(items, "item_id long, text string")

    def outcome():
        found = sorted((tuple(x) for x in decontam.find(table, benchmark).collect()), key=str)
        return found, sorted((tuple(x) for x in decontam.remove(table, benchmark).collect()), key=str)

    small = outcome()
    monkeypatch.setattr(decontam, "BROADCAST_CHARS", 100)
    large = outcome()
    assert len(small[0]) > 200 and small[0] == large[0]
    assert small[1] == large[1]


# --- personal data --------------------------------------------------------------------------


def plain_spans(text):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(len(x.lstrip("0")) <= 3 and int(x[-3:]) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and sum(int(d) if k % 2 == 0 else (2 * int(d) - 9 * (int(d) > 4)) for k, d in enumerate(reversed(digits))) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    return out + [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def test_base_spans_are_the_patterns():
    r = random.Random(14)
    for k in range(20_000):
        letters = "0123456789 -." if k % 3 == 0 else "ab0189.@-+% ()_é"
        text = "".join(r.choice(letters) for _ in range(r.randint(0, 45)))
        assert pii.find_base(text) == plain_spans(text)


@pytest.mark.parametrize(
    ("text", "kind", "found"),
    [
        ("write john.doe [at] example [dot] com now", "email", "john.doe [at] example [dot] com"),
        ("john at example dot com", "email", "john at example dot com"),
        ("x＠ｙ.com", "email", "x＠ｙ.com"),
        ("jоhn@exаmple.com", "email", "jоhn@exаmple.com"),
        ("call plus one five five five one two three four five six seven ok", "phone", "plus one five five five one two three four five six seven"),
        ("j​ohn@exam​ple.com", "email", "j​ohn@exam​ple.com"),
    ],
)
def test_disguises_are_mapped_back(text, kind, found):
    base, every = pii.find_all(text)
    assert (kind, text.index(found), text.index(found) + len(found)) in every
    assert set(base) <= set(every)


def plain_added(text):
    """find_all by its definition: every span of the rewritten text that meets no base span."""
    base, plain = plain_spans(text), pii.deobfuscate(text)
    added = []
    for kind, start, end in plain_spans(plain.text) if plain.text != text else []:
        s, e = plain.source(start, end)
        if all(e <= a or b <= s for _, a, b in base):
            added.append((kind, s, e))
    return base, sorted({*base, *added}, key=lambda x: (pii.KINDS.index(x[0]), x[1], x[2]))


def test_all_spans_are_those_of_the_definition():
    r = random.Random(15)
    parts = ["a", "bob", " at ", " dot ", "[at]", "(dot)", " (at) ", "@", ".", "com", "example", " ", "-at-", "_dot_", "one ", "two ", "three ", "plus ", "1", "12", "255", "аb", "＠", "​", "\n", "+49 ", "é", "a@b.c@d.e@f.g"]
    for _ in range(6_000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 24)))
        assert pii.find_all(text) == plain_added(text), text
    digits = ["0" * 10_000, "9" * 10_000 + ".1.2.3", "0" * 5_000 + "1.2.3.4", "1.2.3." + "0" * 10_000 + "7", "+1" + "2" * 10_000]
    for text in digits:
        assert pii.find_all(text) == plain_added(text)


@pytest.mark.parametrize("text", ["we left at five point two", "I was at home dot dot", "look at example.com", "meet at noon dot then go", "5 at 3.5", "he is at it. dot com"])
def test_ordinary_words_are_no_disguise(text):
    assert pii.find_all(text)[1] == []


@pytest.mark.parametrize("piece", ["a-at-", "a at b dot ", "@", "a@", "[at]x", " dot ", "1 dot 1 ", "a@b.", "one ", "+1 ", "a.", "x [dot] "])
def test_scanning_is_linear(piece):
    import time

    text = piece * (1_000_000 // len(piece)) + " x [dot] y at z dot q"
    began = time.process_time()
    pii.find_all(text)
    assert time.process_time() - began < 8


def test_pii_over_a_table(spark):
    long = "a" * 200_000 + " 1.2.3.4 " + "9" * 100_000 + "@"
    rows = [(1, None), (2, ""), (3, "me@x.org and 10.0.0.1"), (4, long), (3, "me@x.org and 10.0.0.1"), (None, "+1 234 567 89 01")]
    docs = documents(spark, rows)
    got = Counter((x["doc_id"], tuple((s["kind"], s["start"], s["end"]) for s in x["base"])) for x in pii.find(docs).collect())
    assert got == Counter((k, tuple(plain_spans(t or ""))) for k, t in rows if k != 4) + Counter([(4, (("ip", 200_001, 200_008),))])
    masked = {x["doc_id"]: x["text"] for x in pii.mask(docs).collect()}
    assert masked[3] == "<EMAIL> and <IP>" and masked[1] is None and masked[None] == "<PHONE>"
    assert pii.find(documents(spark, [])).count() == 0
