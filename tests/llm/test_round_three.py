"""Clustering, tokenizer alignment and license scan against brute force, and odd input."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fluxsieve.llm import align, centroids, chat, common, decontaminate, licenses, queries, secrets, simhash

DOCS = "doc_id long, text string, lang string"


@pytest.fixture(scope="module", autouse=True)
def _session(spark):
    common.session(spark)


def docs(spark, rows):
    frame = spark.createDataFrame([(i, t, "en") for i, t in rows], DOCS)
    for name in ("id", "text_key", "found", "label", "labels", "block", "docs", "pair", "n", "score"):
        frame = frame.withColumn(name, F.lit("own"))
    return frame


# --- 11 clustering

def vectors(spark, rows, size):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return frame.withColumns({c: F.lit("own") for c in ("id", "q", "cluster", "distance")})


def brute_clusters(rows, k, rounds, size):
    kept = [(i, tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)) for i, v in rows
            if v is not None and len(v) == size and all(x is not None and np.isfinite(np.float32(x)) for x in v)]
    name = lambda i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
    centres = [list(q) for _, q in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def near(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, q in kept:
            groups.setdefault(near(q)[1], []).append(q)
        for n, g in groups.items():
            centres[n] = [sum(col) // len(g) for col in zip(*g)]
    found = [(i, *near(q)[::-1]) for i, q in kept]
    own = Counter()
    for _, n, d in found:
        own[n] += d
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return Counter((i, n, d, own[n], sum(own.values()), shas[n]) for i, n, d in found)


@pytest.mark.parametrize("k", [3, 100])
def test_clusters_equal_brute_force(spark, k):
    rng, size = random.Random(k), 5
    rows = [(i, [rng.gauss(i % 4, 0.3) for _ in range(size)]) for i in range(60)]
    rows += [(200 + i, rows[7][1]) for i in range(40)] + [(300, None), (301, []), (302, [1.0] * 4), (303, [1.0] * 6)]
    rows += [(304, [1.0, None, 1.0, 1.0, 1.0]), (305, [float("nan")] * 5), (306, [float("-inf")] * 5), (None, [0.5] * 5), (7, rows[7][1])]
    found, centres = centroids.clusters(vectors(spark, rows, size).repartition(5), k=k, dimensions=size)
    got = Counter(tuple(r) for r in found.select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect())
    assert got == brute_clusters(rows, k, centroids.ROUNDS, size) and len(centres) <= k


def test_clusters_of_nothing_and_of_huge_components(spark):
    none = vectors(spark, [(1, None), (2, [1.0])], 3)
    found, centres = centroids.clusters(none, dimensions=3)
    assert found.count() == 0 and centres == [] and "centroid_sha256" in found.columns
    far, _ = centroids.clusters(vectors(spark, [(1, [3e38] * 3), (2, [-3e38] * 3), (3, [0.0] * 3)], 3), k=1, dimensions=3)
    assert far.count() == 3 and far.select(F.max("distance")).first()[0] > 1 << 55


def test_clustering_runs_no_python_in_tasks(spark):
    found, _ = centroids.clusters(vectors(spark, [(1, [0.5] * 3)], 3), dimensions=3)
    assert "Python" not in found._jdf.queryExecution().toString() and "Arrow" not in found._jdf.queryExecution().toString()


# --- 12 alignment

ODD_TEXTS = ["", " ", "a", "a  b", "x\ny z\t\tq", " lead", "trail ", "don't we'll", "▁x", "<|endoftext|> <s> </s> <0x0A> <unk>",
             "日本語 テスト", "a ́b", "ﬁ ½ ①", "\x00 \x1c b", "😀 👍🏽 x", "é— “q” 12 34,5", "word " * 3000, "x" * 5000, "\n\n\n", "　a  b"]


def published():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.BYTE_BPE)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(" " + text, add_special_tokens=False).ids


def brute_alignment(rows):
    both, encode_a = align.Pair(queries.BYTE_BPE, queries.PIECE_MODEL), published()
    out, seen = [], Counter()
    for i, text in rows:
        a, b = encode_a(text or ""), both.b.encode(text or "")
        x, y = ([both.spelled[k][t] for t in ids] for k, ids in enumerate((a, b)))
        if not text or b"".join(x) != (" " + text).encode() or b"".join(y) != (" " + text).encode():
            out.append((i, [], [], [], []))
            continue
        spans = lambda parts: list(zip(np.cumsum([0, *map(len, parts[:-1])]).tolist(), np.cumsum(list(map(len, parts))).tolist()))
        sa, sb = spans(x), spans(y)
        cuts = sorted({e for _, e in sa} & {e for _, e in sb})
        groups = [([t for t, (s, e) in zip(a, sa) if lo <= s and e <= hi], [t for t, (s, e) in zip(b, sb) if lo <= s and e <= hi])
                  for lo, hi in zip([0, *cuts], cuts)]
        pairs = [(t, u) for t, (s, e) in zip(a, sa) for u, (p, q) in zip(b, sb) if s < q and p < e] if len(a) < 700 else None
        if pairs is None:  # long texts: links by walking both sides
            pairs, j = [], 0
            for t, (s, e) in zip(a, sa):
                while sb[j][1] <= s:
                    j += 1
                m = j
                while m < len(sb) and sb[m][0] < e:
                    pairs.append((t, b[m]))
                    m += 1
        seen.update(pairs)
        out.append((i, a, b, groups, pairs))
    best = {}
    for (_, u), n in seen.items():
        best[u] = max(best.get(u, 0), n)
    text_of = lambda groups: ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
    return Counter((i, len(a), len(b), len(g), len(p), sum(seen[x] == best[x[1]] for x in p), sum(seen[x] for x in p),
                    hashlib.sha256(text_of(g).encode()).hexdigest() if a else "") for i, a, b, g, p in out)


@pytest.mark.parametrize("size", [50, 1 << 20])
def test_alignment_equals_brute_force(spark, size):
    rng = random.Random(5)
    words = ["the", "Donau", "échaux", "réier", "x1b", "don't", "12", "—", "antidisestablishment", "\n", "  ", "ß"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 60)))) for i in range(60)]
    rows += [(100 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "the Donau"), (3, None), (4, rows[4][1]), (200, rows[4][1])]
    got = align.aligned(docs(spark, rows).repartition(4), queries.BYTE_BPE, queries.PIECE_MODEL, size)
    assert Counter(map(tuple, got.collect())) == brute_alignment(rows)
    assert got.columns == ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert align.aligned(docs(spark, rows).limit(0), queries.BYTE_BPE, queries.PIECE_MODEL).count() == 0


def test_units_encode_like_whole_texts(monkeypatch):
    both, encode_a = align.Pair(queries.BYTE_BPE, queries.PIECE_MODEL), published()
    monkeypatch.setattr(align, "UNITS", 3)  # what is held is dropped again and again
    for text, (a, _, b, _) in zip(ODD_TEXTS * 2, [e for t in ODD_TEXTS * 2 for e in both.encode([t])]):
        if len(a):
            assert a.tolist() == encode_a(text) and b.tolist() == both.b.encode(text)


def test_groups_of_units_encode_like_whole_texts():
    both, encode_a = align.Pair(queries.BYTE_BPE, queries.PIECE_MODEL), published()
    rng = random.Random(8)
    words = ["the", "Donau", "échaux", "ﬁ", "don't", "—", "x\ny", "日本", "½", "a\u0301", "\u0301b", "12", "\x1cq", "a▁q"]
    texts = [" ".join(rng.choice(words[:k]) + rng.choice(["", "", str(i)]) for _ in range(40)) for i, k in enumerate([3, 5, 14] * 20)]
    spelled = 0
    for text, (a, _, b, _) in zip(texts + ODD_TEXTS, both.encode(texts + ODD_TEXTS)):
        wanted = encode_a(text), both.b.encode(text)
        whole = all(b"".join(x[i] for i in ids) == (" " + text).encode() for x, ids in zip(both.spelled, wanted))
        assert (a.tolist(), b.tolist()) == (wanted if whole and text else ([], []))
        spelled += whole and text in texts
    assert 40 <= spelled < len(texts)


def test_portions_align_like_whole_texts(monkeypatch):
    both = align.Pair(queries.BYTE_BPE, queries.PIECE_MODEL)
    texts = [*ODD_TEXTS, "the Donau échaux  x1b\n don't — antidisestablishment ß " * 300, "spelled <0x0A> " * 40 + "\x00 b ﬁ " + "tail " * 40, ""]
    found = []
    for size in (1 << 20, 7, 200):
        monkeypatch.setattr(align, "PORTION", size)
        docs = list(align.documents(both, texts))
        found.append([(d.row(), np.concatenate([*d.codes, np.zeros(0, np.int64)]).tolist()) for d in docs])
        assert all(not d.codes for d in docs if not d.spelled)
        assert size > 200 or max(len(list(both.portions(t))) for t in texts) > 40
    assert found[0] == found[1] == found[2] and any(row == (0, 0, 0, 0, "") for row, _ in found[0][1:-1])


def test_runs_skip_and_regroup():
    rng = random.Random(3)
    for _ in range(300):
        total = rng.randrange(1, 80)
        a, b = (sorted({*rng.sample(range(1, total + 1), rng.randrange(total)), total}) for _ in range(2))
        if rng.random() < 0.5:
            b = sorted({*a, *b}) if rng.random() < 0.5 else list(a)
        found = align.runs(a, b)
        stops = [x for i, p, j, q, plain in found for x in (zip(range(i + 1, p + 1), range(j + 1, q + 1)) if plain else [(p, q)])]
        assert stops == list(zip(*(ends.tolist() for ends in align.group_ends(found))))
        assert stops == [(a.index(e) + 1, b.index(e) + 1) for e in sorted(set(a) & set(b))]
        assert sum(plain for *_, plain in found) <= 1 + sum(not plain for *_, plain in found)


# --- 13 licenses

def example(pattern):
    """A text that a rule's pattern matches: optional parts left out, first alternatives taken."""
    text = re.sub(r"\[([^\]-])[^\]]*\]", r"\1", pattern)
    text = re.sub(r" \.\{1,\d+\}\? ", " some words ", text).replace("( )?", " ")
    while "(" in text:
        text = re.sub(r"\(([^()]*)\)(\??)", lambda m: "" if m[2] else m[1].split("|")[0], text)
    return re.sub(r"(?<=[a-z])\?", "", text)


def brute_licenses(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    held, found = " " + "  ".join(words) + " " if words else "", []
    for n, rule in enumerate(licenses.rules()):  # without the keyword gate
        for m in re.finditer(rule.pattern, held):
            start = held.count(" ", 0, m.start()) // 2
            found.append((start, start + m[0].count(" ") // 2, n))
    kept = sorted((s, e, n) for s, e, n in found if n < 3 or not any(k < n and a <= s and e <= b for a, b, k in found))
    return len(words), kept


def test_every_rule_is_found_and_the_gate_drops_nothing(spark):
    patterns = [r.pattern.strip().replace("  ", " ") for r in licenses.rules()]
    assert len(patterns) > 300
    rows = [(n, "Intro. " + example(p).title() + " END") for n, p in enumerate(patterns)]
    got = {r["id"]: (r["n_words"], [(d["start"], d["end"], d["rule"]) for d in r["found"]]) for r in licenses.scan(docs(spark, rows)).collect()}
    for n, text in rows:
        assert got[n] == brute_licenses(text), text
        whole = licenses.scanner().detections(text)[1]
        assert any(rule == n for _, _, rule in whole), (patterns[n], text)


def test_licenses_of_odd_and_overlapping_texts(spark):
    lesser = "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1"
    rows = [(1, None), (2, ""), (3, "!!"), (4, "mit mit_license mité license"), (4, "mit mit_license mité license"), (None, "CC-BY-NC"),
            (5, lesser), (6, ("Under the MIT License. Apache License, Version 2.0; cc by nc sa " * 400)), (7, "under the mit license under the mit license"),
            (8, "word " * 60_000 + "SPDX-License-Identifier: GPL-3.0-or-later"), (9, "x" * 100_000), (10, "mit—license MIT-Lizenz mit uns")]
    out = licenses.labelled(docs(spark, rows).repartition(3)).collect()
    assert Counter((r["id"], r["n_words"], tuple((d["start"], d["end"], d["rule"]) for d in r["found"])) for r in out) == Counter(
        (i, n, tuple(k)) for i, t in rows for n, k in [brute_licenses(t)])
    labels = {r["id"]: (r["labels"], r["score"]) for r in out}
    assert labels[1] == labels[3] == labels[9] == labels[10] == ([], 0.0) and labels[5] == (["lgpl-2.1"], 1.0)
    assert labels[6][0] == ["apache-2", "cc-by-nc", "cc-by-nc-sa", "mit"] and labels[8] == (["gpl-3"], 0.9)
    assert licenses.labelled(docs(spark, rows).limit(0)).count() == 0


def test_suppression_equals_its_definition():
    rng = random.Random(9)
    for _ in range(200):
        found = list({(s := rng.randrange(30), s + rng.randrange(1, 9), rng.randrange(12)) for _ in range(rng.randrange(25))})
        want = sorted(d for d in found if d[2] < 3 or not any(e[2] < d[2] and e[0] <= d[0] and d[1] <= e[1] for e in found))
        assert licenses.surviving(found) == want


# --- 5 and 6: what this round mended

def test_secret_scan_grows_with_a_runs_length_and_with_the_number_of_runs(spark):
    import time

    rng = random.Random(4)
    many = " ".join("".join(rng.choice("abcdefghij") for _ in range(17)) for _ in range(100_000))
    long = "".join(rng.choice(secrets.CHARACTERS) for _ in range(1 << 20))
    rows = [(1, long), (2, many), (3, "é " * 700 + "password = hunter2hunter2"), (4, "a" * 700)]
    start = time.time()
    got = {r["id"]: r for r in secrets.spans(docs(spark, rows)).collect()}
    assert time.time() - start < 120
    assert [tuple(s) for s in got[3]["base"]] == [(1400, 0, 1425)]
    assert all(tuple(s) == (18 * i, 3, 18 * i + 17) for i, s in enumerate(sorted(got[2]["spans"]))) or len(got[2]["spans"]) < 100_000


def test_running_sums(spark):
    for n in (1, 2, 255, 256, 257, 1000, 70_000):
        lengths = [random.Random(n + i).randrange(5) for i in range(min(n, 300))] * (n // 300 + 1)
        row = spark.createDataFrame([(lengths[:n],)], "x array<int>").select(secrets.running(F.col("x")).alias("s")).first()
        assert row["s"] == np.concatenate([[0], np.cumsum(lengths[:n])[:-1]]).tolist()


def test_conversations_beyond_doubles_pair_rightly(spark):
    base = 1 << 60
    rows = [(base + i, 0, "user", f"t{i // 2}") for i in range(6)]
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    got = {(r["pair_id"], r["chosen_id"], r["rejected_id"], r["n_shared"]) for r in chat.preferences(chat.neighbours(frame)).collect()}
    assert got == {((base >> 1) + k, base + 2 * k, base + 2 * k + 1, 1) for k in range(3)}


def test_filter_bits_are_gathered_in_words(spark):
    hashes = [0, 63, 64, (7 << 32) | 5, (1 << 62) + 12345, -1]
    rows = spark.createDataFrame([(h,) for h in hashes], "h long")
    made = decontaminate.bloom(rows)
    assert made.dtype == np.uint8 and len(made) == decontaminate.BLOOM_BITS // 8
    wanted = np.zeros(decontaminate.BLOOM_BITS, bool)
    for h in hashes:
        wanted[[h & (decontaminate.BLOOM_BITS - 1), (h % (1 << 64) >> 32) & (decontaminate.BLOOM_BITS - 1)]] = True
    assert (np.unpackbits(made, bitorder="little").astype(bool) == wanted).all()
    assert decontaminate.may_hold(made, np.array(hashes, np.int64).view(np.uint64)).all()


def test_found_components_come_back_as_stars(spark):
    """Links in a chain and all their pairs leave one edge a node, so that later contractions have few edges."""
    n = 12
    points = spark.range(n).select(F.col("id").alias("node"), F.lit(100).alias("shingles"), F.col("id").alias("text_key"), *[
        F.lit(0).cast("long").alias(c) for c in simhash.NAMES])
    pairs = spark.createDataFrame([(a, b) for a in range(n) for b in range(a + 1, n)], "a long, b long")
    docs = spark.createDataFrame([("t",)], "text string")
    none = spark.createDataFrame([], "a long, b long")
    found = simhash._links(docs, points, pairs, none, 5, 0.8)
    assert sorted(map(tuple, found.collect())) == [(0, b) for b in range(1, n)]


def _versions(rng, base, changes, tag):
    """The words with that many of them, anywhere, replaced by new ones or by one of a few."""
    out = list(base)
    for k, at in enumerate(rng.sample(range(len(out)), changes)):
        out[at] = rng.choice(["one", "two", f"{tag}n{k}"])
    return " ".join(out)


def _similar_parts(nodes, sets, joined, similarity=0.8):
    """Components of all pairs that are joined already or similar enough, by comparing every pair."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in joined:
        root[find(a)] = find(b)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            common = len(sets[a] & sets[b])
            if common >= similarity * (len(sets[a]) + len(sets[b]) - common):
                root[find(a)] = find(b)
    parts = {}
    for n in nodes:
        parts.setdefault(find(n), set()).add(n)
    return sorted(map(sorted, parts.values()))


def test_families_lose_no_similar_pair(spark):
    """Versions of a text near the threshold, cut-off ones, pairs far from it, other texts and sizes: as all pairs compared."""
    rng = random.Random(41)
    word = lambda k: [f"w{rng.randrange(400)}" for _ in range(k)]
    base = word(150)
    texts = [_versions(rng, base, rng.choice([0, 1, 2]), f"t{i}") for i in range(60)]
    texts += [_versions(rng, base, rng.choice([2, 3, 4, 6, 9]), f"o{i}") for i in range(150)]
    texts += [_versions(rng, t.split(), 1, f"c{i}") for i, t in enumerate(texts[-40:])]
    texts += [" ".join(base[:k]) for k in range(100, 150, 3)] + [" ".join(word(k)) for k in (1, 3, 20, 140, 160, 900)]
    texts = list(dict.fromkeys(texts))
    sets = {i: set(simhash.shingles(t, 5).astype(np.uint32).tolist()) for i, t in enumerate(texts)}
    label = {i: 0 if i < 60 else i for i in sets}
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    points = rows.select("node", F.xxhash64("text").alias("text_key"))
    family = spark.createDataFrame([(0, i, k) for i, k in label.items()], "top long, node long, label long")
    links, pairs = (sorted({tuple(sorted(r)) for r in f.collect()}) for f in simhash._families(docs, points, family, 5, 0.8))
    known = [(i, k) for i, k in label.items()]
    similar = [(a, b) for a, b in pairs if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    assert all(len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) for a, b in links)
    wanted = _similar_parts(list(sets), sets, known)
    assert _similar_parts(list(sets), {i: {-1 - i} for i in sets}, known + links + similar) == wanted
    assert len(wanted) > 50 and len(pairs) < 4 * len(texts)


def test_versions_too_far_apart_make_few_pairs(spark, monkeypatch):
    """Versions of one text that are no near copies of each other were paired with the whole group, for every list they share."""
    rng = random.Random(42)
    base = [f"w{rng.randrange(400)}" for _ in range(150)]
    texts = [_versions(rng, base, 1, f"t{i}") for i in range(80)] + [_versions(rng, base, 4, f"o{i}") for i in range(120)]
    sets = {i: set(simhash.shingles(t, 5).astype(np.uint32).tolist()) for i, t in enumerate(texts)}
    made, links = [], simhash._links
    monkeypatch.setattr(simhash, "_links", lambda docs, points, pairs, *more: made.append(pairs.count()) or links(docs, points, pairs, *more))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["id"]: r["component_id"] for r in simhash.similar(docs).collect()}
    assert {i: p[0] for p in _similar_parts(list(sets), sets, []) for i in p} == got
    assert len(made) == 2 and made[1] < 25 * len(texts)
