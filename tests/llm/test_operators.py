"""The ten operators against brute force, and their defined results for odd input."""

import base64
import gzip
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from fluxsieve.llm import (chat, common, decontaminate, exact_dedup, language, lm_score, pieces, queries, secrets,
                           simhash, url_filter, warc)

DOCS = "doc_id long, text string, lang string"
WORD_LIST = ("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau "
             "upsilon phi chi psi omega").split()


@pytest.fixture(scope="module", autouse=True)
def _session(spark):
    common.session(spark)


def docs(spark, rows, extra=False):
    """(id, text) rows; with ``extra``, columns whose names the operators use inside."""
    frame = spark.createDataFrame([(i, t, "en") for i, t in rows], DOCS)
    if extra:
        for name in ("id", "text_key", "row", "copies", "digest", "key", "fp", "component_id", "p", "kept", "found", "n"):
            frame = frame.withColumn(name, F.lit("own"))
    return frame


def prose(seed, count, words=40):
    rng = random.Random(seed)
    return [" ".join(rng.choice(WORD_LIST) + str(rng.randrange(30)) for _ in range(words)) for _ in range(count)]


ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "alpha"), (4, "alpha"), (None, "alpha"), (None, None), (5, "ALPHA  beta"),
       (6, "ALPHA beta"), (7, "é\u2581\U0001F600 \x00 ok"), (8, "long word " * 30_000), (9, "x" * 50_000)]


# --- 1 exact dedup

def brute_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return Counter(out)


@pytest.mark.parametrize("counters", [1, 3, 1000])
def test_exact_decisions_with_hot_groups(spark, counters):
    rows = ODD + [(100 + i, "hot  text") for i in range(60)] + [(300 + i, t) for i, t in enumerate(prose(1, 30) * 2)]
    got = exact_dedup.decisions(docs(spark, rows).repartition(5), counters).select(
        "id", "keep_id", "group_size", "kept", "digest").collect()
    assert Counter(map(tuple, got)) == brute_exact(rows)


def test_summary_holds_every_heavy_digest_and_is_bounded(spark):
    values = ["a"] * 300 + ["b"] * 120 + [f"u{i}" for i in range(500)]
    random.Random(2).shuffle(values)
    keys = spark.createDataFrame([(v,) for v in values], "digest string").repartition(7)
    found = {r["digest"]: r["at_least"] for r in exact_dedup.summary(keys, 9).collect()}
    part = len(values) / 10
    assert {d for d, n in found.items() if n > part} >= {"a"} and sum(n > part for n in found.values()) <= 9
    assert found["a"] <= 300 and found["a"] >= 300 - part


def test_exact_survivors_keep_columns_and_one_row_of_each_text(spark):
    rows = ODD + [(100 + i, "hot") for i in range(20)]
    frame = docs(spark, rows, extra=True)
    out = exact_dedup.survivors(frame)
    assert out.columns == frame.columns
    kept = [(r["doc_id"], r["text"]) for r in out.collect()]
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in kept]
    assert len(texts) == len(set(texts)) == len({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows})
    assert (100, "hot") in kept and (5, "ALPHA  beta") in kept


# --- 2 language

def test_language_is_learned_and_odd_texts_are_undetermined(spark):
    rng = random.Random(3)
    parts = {"aa": ["ka", "lo", "mi", "ra"], "bb": ["sch", "ung", "ber", "ein"]}
    rows = []
    for i in range(120):
        lang = ("aa", "bb")[i % 2]
        text = " ".join("".join(rng.choice(parts[lang]) for _ in range(3)) for _ in range(30))
        rows.append((i, text, lang))
    rows += [(1000, None, "aa"), (1001, "123 ... !!", "bb"), (None, "kalomi rakalo", None), (1002, "", "aa")]
    frame = spark.createDataFrame(rows, DOCS)
    got = {r["doc_id"]: r for r in language.predictions(frame).collect()}
    assert all(got[i]["lang_pred"] == lang for i, _, lang in rows[:120])
    assert {got[i]["lang_pred"] for i in (1000, 1001, 1002)} == {"und"} and got[1000]["score"] == 0
    assert got[None]["held_out"] is False and got[None]["lang_pred"] == "aa"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    kept = language.identified(frame)
    assert kept.columns == frame.columns and kept.count() == 121
    assert language.predictions(frame.limit(0)).count() == 0
    assert {r["lang_pred"] for r in language.predictions(frame.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def greedy(symbols, body):
    """Phrases of one parse from start to end; ``body`` holds one character per symbol."""
    rest, count = "".join(map(chr, symbols)), 0
    while rest:
        n = 1
        while n < len(rest) and rest[:n + 1] in body:
            n += 1
        rest, count = rest[n:], count + 1
    return count


@pytest.mark.parametrize("in_step, cells", [(1, 0), (8, 0), (1 << 16, 0), (1 << 16, 1 << 23)])
def test_phrases_equal_one_greedy_parse_of_the_whole_text(monkeypatch, in_step, cells):
    monkeypatch.setattr(language, "CELLS", cells)
    monkeypatch.setattr(language, "SEGMENT", 16)
    monkeypatch.setattr(language, "IN_STEP", in_step)
    rng = random.Random(4)
    samples = [("x", ["".join(rng.choice("abc ") for _ in range(400))]), ("y", ["".join(rng.choice("bcd ") for _ in range(300))]),
               ("z", ["ab" * 100])]
    model = language.Model(samples)
    texts = ["".join(rng.choice("abcd\u00e9 ") for _ in range(n)) for n in (1, 5, 16, 60, 1024, 2500)] + ["ab" * 90, samples[0][1][0]]
    parsed = [language.letters(t, model.classes) for t in texts]
    got = model.phrases(parsed)
    for k, (_, own) in enumerate(samples):
        body = "".join(map(chr, [*language.letters(own[0], model.classes), 0]))
        assert [greedy(p, body) for p in parsed] == got[k].tolist()
    assert got[0][-1] == 1 and model.phrases([]).shape == (3, 0)


def test_every_label_is_learned_and_predicted(spark):
    rng = random.Random(9)
    rows, scripts = [], [chr(0x4E00 + i) for i in range(2000)]
    for k in range(200):
        own = [rng.choice(scripts) for _ in range(10)]
        rows += [(3 * k + i, " ".join("".join(rng.choice(own) for _ in range(4)) for _ in range(25)), f"l{k:03}") for i in range(3)]
    rows += [(5000, rows[0][1], "l000"), (5001, rows[0][1], "l000"), (5002, rows[0][1] * 400, None)]
    frame = spark.createDataFrame(rows, DOCS)
    for name in ("p", "h", "place", "row", "score"):
        frame = frame.withColumn(name, F.lit("own"))
    learned = {lang for i, _, lang in rows if lang and zlib.crc32(str(i).encode()) % 4 != 2}
    got = {r["doc_id"]: r["lang_pred"] for r in language.predictions(frame).collect()}
    known = [(i, lang) for i, _, lang in rows if lang in learned]
    assert len(learned) > 180 and sum(got[i] == lang for i, lang in known) >= 0.97 * len(known)
    assert got[5002] == "l000"
    assert language.identified(frame).columns == frame.columns


def test_shares_are_even_and_leave_nothing():
    assert language.shares([10, 1, 10], 12) == [5, 1, 6] and language.shares([3, 4], 100) == [3, 4]


def test_equally_cheap_languages_go_to_the_first(spark):
    model = language.Model([("a", ["same words"]), ("b", ["same words"])])
    assert model.predict(["same words", None]).values.tolist()[0][:2] == ["a", 0.0]


def test_held_out_accuracy(spark):
    frame = common.table(spark, "/root/testdata/sf0.001", "documents")
    both = language.predictions(frame).join(frame.select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = both.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 30 and right / n >= 0.97


# --- 3 WARC

def test_archives_round_trip_and_resolve(spark, tmp_path):
    bodies = ["<p>é</p>", "", None, "a\r\n\r\nWARC/1.1\r\n", "x" * 20_000, "<p>é</p>"]
    rows = [(i, f"http://h/{i}\r\nX: y" if i == 3 else f"http://h/{i}", b) for i, b in enumerate(bodies * 3)]
    rows += [(None, None, "<p>é</p>"), (4, "http://h/again", "x" * 20_000)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1))
    warc.write(frame.repartition(3), str(tmp_path / "a"), file_records=4)
    found = warc.read(spark, str(tmp_path / "a"))
    whole = {r["record_id"]: bytes(r["payload"]) for r in found.where("record_type = 'response'").collect()}
    assert sorted(set(whole.values())) == sorted({(b or "").encode() for b in bodies})
    got = {r["page_id"]: r for r in warc.resolve(found).collect()}
    last = {}
    for i, _, b in rows:
        if i is not None:
            last[b or ""] = max(i, last.get(b or "", -1))
    for i, _, b in rows:
        r, data = got[i], (b or "").encode()
        assert r["payload_bytes"] == len(data)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
        first = i == last[b or ""]
        assert (r["record_type"], r["refers_to"]) == (("response", None) if first else ("revisit", last[b or ""]))
    assert found.count() == len(rows) and "\r" not in got[3]["url"]
    warc.write(frame.limit(0), str(tmp_path / "b"))
    assert warc.read(spark, str(tmp_path / "b")).count() == 0


def test_archives_are_bounded_by_bytes(spark, tmp_path):
    sizes = [0, 1, 100, 101, 1616, 1617, 3000, 30_000, 5 << 20]
    rows = [(10 * k + i, f"http://h/{k}/{i}", chr(97 + i % 26) * n + str(k % 2)) for i, n in enumerate(sizes) for k in range(6)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write(frame.coalesce(1), str(tmp_path / "a"), file_records=100, file_bytes=10_000)
    held = {}
    for file in (tmp_path / "a").rglob("part-*"):
        found = [len(p) for h, p in warc._parse(warc._unpacked(file.read_bytes())) if h["WARC-Type"] == "response"]
        held[str(file)] = found
        assert sum(found) <= 10_000 + 100 or len(found) == 1
    assert sum(map(len, held.values())) == 2 * len(sizes)
    found = warc.read(spark, str(tmp_path / "a"))
    got = {r["page_id"]: r for r in warc.resolve(found).collect()}
    assert len(got) == len(rows)
    for i, _, html in rows:
        last = max(j for j, _, other in rows if other == html)
        assert got[i]["payload_bytes"] == len(html) and got[i]["refers_to"] == (None if last == i else last)


def test_archives_come_in_any_portions_and_members(monkeypatch):
    block = "HTTP/1.1 200 OK\r\n\r\n"
    one = lambda i, body: (f"WARC/1.1\r\nWARC-Record-ID: {i}\r\nContent-Length: {len(block) + len(body)}\r\n\r\n{block}{body}\r\n\r\n").encode()
    bodies = ["", "x" * 300, "a\r\n\r\nWARC/1.1\r\n", "y"]
    plain = [one(i, b) for i, b in enumerate(bodies)]
    for portion in (1, 7, 1 << 20):
        monkeypatch.setattr(warc, "PORTION", portion)
        for content in (b"".join(plain), gzip.compress(b"".join(plain)), b"".join(map(gzip.compress, plain))):
            assert [p.decode() for _, p in warc._parse(warc._unpacked(content))] == bodies
    with pytest.raises(ValueError, match="cut off"):
        list(warc._parse(iter([plain[1][:-100]])))
    assert list(warc._parse(warc._unpacked(b""))) == []


# --- 4 SentencePiece

@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary(queries.PIECE_MODEL)


def test_pieces_are_lossless_and_reproducible(spark, vocabulary):
    frame = docs(spark, ODD + [(20 + i, t) for i, t in enumerate(prose(5, 20))], extra=True)
    one = {(r["id"], r["decoded_sha256"]): r for r in pieces.encoded(frame.repartition(1), queries.PIECE_MODEL).collect()}
    two = {(r["id"], r["decoded_sha256"]): r for r in pieces.encoded(frame.repartition(6), queries.PIECE_MODEL).collect()}
    assert one == two and all(r["lossless"] for r in one.values())
    assert one[(1, None)]["ids"] is None and one[(1, None)]["n_pieces"] is None
    assert one[(2, hashlib.sha256(b"").hexdigest())]["ids"] == []
    assert all(pieces.decode(r["ids"], vocabulary) is not None for r in one.values() if r["ids"])
    other = pieces.encoded(frame, queries.PIECE_MODEL, seed=7)
    assert [r["ids"] for r in other.where("id = 20").collect()] != [r["ids"] for k, r in one.items() if k[0] == 20]


def test_sampled_segmentations_follow_the_exact_distribution(vocabulary):
    text, n = "thing", 20_000

    def paths(rest):
        if not rest:
            yield (), 0.0
        for k in range(1, len(rest) + 1):
            if rest[:k] in vocabulary.place:
                piece = vocabulary.place[rest[:k]]
                for tail, weight in paths(rest[k:]):
                    yield (piece, *tail), weight + vocabulary.weight[piece]

    weights = {p: math.exp(w) for p, w in paths(" " + text)}
    total = sum(weights.values())
    flat, per = pieces.sample([text] * n, np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), pieces.Lattice(vocabulary))
    ends = np.cumsum(per)
    drawn = Counter(tuple(flat[e - k:e].tolist()) for e, k in zip(ends, per))
    assert set(drawn) <= set(weights)
    for path, weight in weights.items():
        share = weight / total
        assert abs(drawn[path] / n - share) < 5 * math.sqrt(share * (1 - share) / n) + 1e-4


# --- 5 secrets

def brute_base(text):
    found = []
    assign = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
    for rank, (pattern, group, least) in enumerate([(assign, 2, 8), (re.compile("AKIA[A-Z0-9]+"), 0, 16), (re.compile("[0-9a-f]+"), 0, 32)]):
        found += [(m.start(), rank, m.end()) for m in pattern.finditer(text) if len(m.group(group)) >= least]
    return sorted(found)


SECRETS = ["é \U0001F600 password: hunter22hunter and Token='abc'; api_key= \"" + "ab12" * 10 + "\" x", "AKIA" + "Z9" * 8 + " AKIAXX",
           "deadbeef" * 5 + " " + "deadbeef" * 3, "token=api_key: abcdefghij", "secret=secret=abcdefgh.ij", None, "", "PASSWD  =  x" + "y" * 9,
           "plain words only thhationing" * 5]


def test_base_spans_equal_brute_force(spark):
    rows = list(enumerate(SECRETS)) + [(7, SECRETS[7]), (50, "long text " * 20_000 + "secret: 'abcdefgh12'")]
    got = secrets.spans(docs(spark, rows, extra=True)).collect()
    assert len(got) == len(rows)
    by = dict(rows)
    for r in got:
        assert [tuple(s) for s in r["base"]] == brute_base(by[r["id"]] or "")
        assert set(map(tuple, r["base"])) <= set(map(tuple, r["spans"]))


def test_character_models_add_random_runs_only(spark):
    rng = random.Random(6)
    random_run = lambda: "".join(rng.choice("0123456789abcdefghijkmnpqrstuvwxyz") for _ in range(40))
    rows = [(i, f"the identifier_of_some_function_name and another_long_identifier token = {random_run()}") for i in range(400)]
    rows += [(1000, "lone " + random_run() + " here"), (1001, "some_function_name_of_another_identifier only")]
    got = {r["id"]: r for r in secrets.spans(docs(spark, rows)).collect()}
    assert [tuple(s) for s in got[1000]["spans"]] == [(5, 3, 45)] and not got[1001]["spans"]
    model = secrets.ratios(secrets.scan(docs(spark, rows)))
    run = rows[400][1].split()[1]
    places = [secrets.CHARACTERS.index(c) for c in run]
    want = sum(model[a * len(secrets.CHARACTERS) + b] for a, b in zip(places, places[1:]))
    one = spark.createDataFrame([(run,)], "r string").select(secrets.ratio(F.col("r"), model).alias("x")).first()
    assert one["x"] == want


# --- 6 chat

def test_prefix_prompt_and_masks(spark):
    rows = [(0, 0, "user", "hi"), (0, 1, "assistant", "good é"), (0, 2, "user", None), (0, 3, "assistant", "yes"),
            (1, 0, "user", "hi"), (1, 1, "assistant", "good é"), (1, 2, "user", ""), (1, 3, "assistant", "no <|im_end|>"),
            (2, 0, None, "alone"), (2, 0, None, "alone"), (None, 0, "user", "lost"), (4, 0, "user", "same"), (5, 0, "user", "same")]
    got = {r["pair_id"]: r for r in chat.preferences(chat.neighbours(
        spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("side", F.lit(9)))).collect()}
    assert set(got) == {0, 1, 2}
    r = got[0]
    assert r["n_shared"] == 3 and r["prompt"].count("<|im_start|>") == 3
    for side, said in (("chosen", "yes"), ("rejected", "no < |im_end|>")):
        (span,) = r[f"{side}_mask"]
        assert r[side][span["start"]:span["end"]] == said + "<|im_end|>\n"
    assert got[1]["rejected"] is None and got[1]["prompt"] == "" and "unknown\nalone" in got[1]["chosen"]
    assert got[1]["chosen"].count("alone") == 1
    assert got[2]["chosen"] == got[2]["rejected"] == "" and got[2]["n_shared"] == 1
    assert chat.preferences(chat.neighbours(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0


# --- 7 urls

def brute_urls(rows):
    def split(url):
        if url is None or "://" not in url:
            return "", ""
        m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S)
        return "".join(c.lower() if c in common.UPPER else c for c in m[1]), m[2]

    def rule(host, path):
        fits = [(d, h + p) for d, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fits, key=lambda r: len(r[1]), default=(None, None))

    def template(path):
        own = [s for s in path.split("/") if s]
        return tuple("*" if re.search(url_filter.VARIABLE, s) else s for s in own)

    found = [(i, *split(u), *rule(*split(u))) for i, u in rows]
    leaves = {}
    for _, host, path, decision, _ in found:
        n, b = leaves.get((host, template(path)), (0, 0))
        leaves[host, template(path)] = (n + (decision is not None), b + (decision == "block"))
    m, (n_all, b_all) = url_filter.SMOOTHING, map(sum, zip(*leaves.values()))
    prior, state = b_all / n_all if n_all else 0.0, {}
    for host in {h for h, _ in leaves}:
        n, b = map(sum, zip(*[v for (h, _), v in leaves.items() if h == host]))
        state |= {k: ((), (b + m * prior) / (n + m)) for k in leaves if k[0] == host}
    for level in range(max((len(t) for _, t in leaves), default=0)):
        live = [k for k in leaves if len(k[1]) > level]
        count = lambda keys: tuple(map(sum, zip(*[leaves[k] for k in keys])))
        named = {}
        for k in live:
            siblings = [x for x in live if x[0] == k[0] and state[x][0] == state[k][0]]
            n, b = count(siblings)
            own_n, own_b = count([x for x in siblings if x[1][level] == k[1][level]])
            rest = n - own_n
            apart = bool(own_n and rest) and abs(own_b / own_n - (b - own_b) / rest) > url_filter.Z * math.sqrt(
                b / n * (1 - b / n) * (1 / own_n + 1 / rest))
            alone = len({x[1][level] for x in siblings}) == 1
            named[k] = (state[k][0] + (k[1][level] if apart or alone else "*",), n, b)
        after = {}
        for k in live:
            own_n, own_b = count([x for x in live if x[0] == k[0] and named[x][0] == named[k][0]])
            share = state[k][1] if (own_n, own_b) == named[k][1:] else (own_b + m * state[k][1]) / (own_n + m)
            after[k] = (named[k][0], share)
        state |= after
    return {i: (host, path, rule_text, decision or ("block" if state[host, template(path)][1] >= url_filter.REJECT else "allow"))
            for i, host, path, decision, rule_text in found}


def test_urls_equal_brute_force(spark):
    rng = random.Random(7)
    hosts = ["a.example.com", "B.example.com", "example.org", "x.example.org", "c.net", "spam.com", "com", "notorg"]
    rows = [(i, f"http://{rng.choice(hosts)}/{rng.choice(['de', 'fr', 'en', 'es', 'shop', 'x'])}/"
                f"{rng.choice(['1', '27.html', 'about', 'a1b2c3', 'deadbeef01'])}{rng.choice(['', '?q=1', '#t', '/p/q/r/s/t', '/p/q/r/s/t/u/v/w', '/p/q/r/s/z'])}") for i in range(400)]
    rows += [(900, None), (901, "no scheme"), (902, "http://"), (903, "http://EXAMPLE.ORG"), (904, "x://org/://com/de/"), (900, None),
             (905, "http://example.org/es/" + "s/" * 5000), (None, "http://example.org?x")]
    frame = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("own")).withColumn("share", F.lit(1))
    got = url_filter.verdicts(frame).collect()
    assert len(got) == len(rows)
    want = brute_urls(rows)
    assert all((r["host"], r["path"], r["rule"], r["verdict"]) == want[r["page_id"]] for r in got)
    assert {v[3] for i, v in want.items() if v[2] is None} == {"allow", "block"}
    assert url_filter.verdicts(frame.limit(0)).count() == 0


# --- 8 decontamination

def brute_hits(texts, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c in common.UPPER else c for c in t or ""))
    windows = {}
    for i, t in items:
        w = words(t)
        for s in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[s:s + 10]), set()).add(i)
    out = []
    for t in texts:
        w, hit, found = words(t), set(), set()
        for size in {len(k) for k in windows}:
            for s in range(len(w) - size + 1):
                own = windows.get(tuple(w[s:s + size]))
                if own:
                    hit |= set(range(s, s + size))
                    found |= own
        out.append((len(w), len(hit), sorted(map(str, found))))
    return out


def test_hits_equal_brute_force(spark):
    rng = random.Random(8)
    items = list(enumerate(prose(9, 12, 25))) + [(50, "alpha beta"), (51, "One"), (52, None), (53, "..."), (54, "é x " * 8), (0, prose(9, 1, 25)[0])]
    texts = []
    for i in range(120):
        own = prose(100 + i, 1, 60)[0].split()
        item = (items[rng.randrange(12)][1]).split()
        k = rng.randrange(5, 20)
        at = rng.randrange(40)
        texts.append(" ".join(own[:at] + [w.upper() + "," for w in item[:k]] + own[at:]))
    texts += [None, "", "alpha Beta gamma", "one", "a" * 100_000, "the " * 50_000, items[3][1], items[3][1], "é x " * 20]
    frame = docs(spark, list(enumerate(texts)), extra=True)
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("h", F.lit("own"))
    got = {r["id"]: (r["n_words"], r["n_hit"], r["items"]) for r in decontaminate.decisions(frame.repartition(4), bench).collect()}
    want = brute_hits(texts, items)
    assert all(got[i] == want[i] for i in range(len(texts)))
    assert 40 < sum(n > 0 for _, n, _ in want) < len(texts)
    kept = decontaminate.clean(frame, bench)
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i, (_, n, _) in enumerate(want) if not n]
    assert decontaminate.clean(frame, bench.limit(0)).count() == len(texts)
    assert decontaminate.decisions(frame.limit(0), bench).count() == 0


# --- 9 near-dedup

def brute_components(rows, size):
    import xxhash

    prints = []
    for _, t in rows:
        w = "".join(c.lower() if c in common.UPPER else c for c in t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", w)
        grams = [" ".join(w[i:i + size]) for i in range(len(w) - size + 1)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    names = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            names[find(i)] = min(d, names.get(find(i), d))
    return Counter((d, prints[i], names.get(find(i))) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("longest", [24, 2])
def test_components_equal_brute_force(spark, monkeypatch, longest):
    monkeypatch.setattr(simhash, "LIST", longest)
    rng, base = random.Random(10), prose(11, 6, 120)
    rows = list(ODD[:10])
    for i in range(150):
        words = base[i % 6].split()
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(9)}"
        rows.append((100 + i, " ".join(words)))
    got = simhash.components(docs(spark, rows, extra=True).repartition(3), 3).collect()
    assert Counter((r["id"], r["fp"] % (1 << 64), r["component_id"]) for r in got) == brute_components(rows, 3)


def test_links_of_crowded_lists_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(simhash, "LIST", 2)
    rng = random.Random(12)
    centre = rng.getrandbits(63)
    prints = {centre ^ sum(1 << b for b in rng.sample(range(62), rng.randrange(5))) for _ in range(300)}
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    edges = {tuple(sorted((r["a"], r["b"]))) for r in simhash.links(frame).collect()}
    parts = lambda pairs: {frozenset(c) for c in _parts(prints, pairs)}
    true = {(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 2}
    assert parts(edges) == parts(true)


def _parts(nodes, pairs):
    group = {n: {n} for n in nodes}
    for a, b in pairs:
        if group[a] is not group[b]:
            group[a] |= group[b]
            for n in group[b]:
                group[n] = group[a]
    return {id(g): g for g in group.values()}.values()


def test_similar_documents_leave_one_row(spark):
    rng, base = random.Random(13), prose(14, 30, 200)
    rows = [(i, t) for i, t in enumerate(base)]
    for i, t in enumerate(base[:20]):
        words = t.split()
        words[rng.randrange(200)] = "changed"  # five of 196 shingles: similarity of about 0.95
        rows.append((100 + i, " ".join(words)))
    frame = docs(spark, rows + [(200, None), (201, ""), (202, "short one"), (202, "short one")], extra=True)
    out = simhash.survivors(frame)
    kept = sorted(r["doc_id"] for r in out.collect())
    assert out.columns == frame.columns
    assert set(range(30)) | {200, 202} <= set(kept) and len(kept) == 32
    assert simhash.survivors(frame.limit(0)).count() == 0


def _apart(words, changes, tag):
    """The words with every k-th one changed, so that each change costs five shingles."""
    out = list(words)
    for c in range(changes):
        out[(2 * c + 1) * len(out) // (2 * changes)] = f"{tag}{c}"
    return " ".join(out)


def _jaccard(a, b):
    x, y = (set(simhash.shingles(t, 5).tolist()) for t in (a, b))
    return len(x & y) / len(x | y)


def _linked(spark, rows):
    got = {r["id"]: r["component_id"] for r in simhash.similar(docs(spark, rows).repartition(5)).collect()}
    return got, sum(got[i] == got[10_000 + i] for i in got if i < 10_000 and 10_000 + i in got)


def test_similar_pairs_survive_unrelated_heads(spark, monkeypatch):
    """Fingerprints by hand: all lists that a pair shares hold six documents like neither, whose ids vary."""
    rng, texts, prints = random.Random(31), prose(32, 240, 100), {}
    rows = [(i, t) for i, t in enumerate(texts)] + [(10_000 + i, _apart(texts[i].split(), 1, f"x{i}n")) for i in range(30)]
    for i in range(30):
        both = [rng.getrandbits(63), rng.getrandbits(63)]
        for k in range(i, 240, 30):  # two fingerprints are the same, and half of all other bits differ
            prints[k] = both + [rng.getrandbits(63) for _ in range(simhash.SEEDS - 2)]
        prints[10_000 + i] = both + [p ^ 0x0101010101010101 for p in prints[i][2:]]  # one bit of each byte differs
    names = ["fp", *[f"fp{i}" for i in range(1, simhash.SEEDS)]]
    planted = spark.createDataFrame([(i, *p) for i, p in prints.items()], "id long, " + ", ".join(f"{n} long" for n in names))
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, *_, **__: docs.select(*common.identity()).join(planted, "id"))
    got, found = _linked(spark, rows)
    assert found == 30 and len(set(got.values())) == 240


def test_pairs_across_crowded_lists_are_all_made(spark, monkeypatch):
    monkeypatch.setattr(simhash, "LIST", 3)
    rng = np.random.default_rng(33)
    points = spark.createDataFrame([(i, *map(int, rng.integers(0, 1 << 60, simhash.SEEDS))) for i in range(40)],
                                   "node long, " + ", ".join(f"{n} long" for n in simhash.NAMES))
    # key 1: one large component and three others; key 2: two members only, of one component
    members = [(1, i, 0 if i < 30 else i) for i in range(33)] + [(2, 0, 0), (2, 1, 0)]
    frame = spark.createDataFrame(members, "key long, node long, label long")
    got = Counter((r["a"], r["b"]) for r in simhash._across(points, frame).collect())
    assert got == Counter((a, b) for b in range(30, 33) for a in range(b))


def test_no_window_in_similar(spark, monkeypatch):
    """A window brings all postings of a key to one task; heads are minima, combined before they are shuffled."""
    made, held = [], Window.partitionBy
    monkeypatch.setattr(Window, "partitionBy", staticmethod(lambda *c: made.append(c) or held(*c)))
    simhash.similar(docs(spark, list(enumerate(prose(35, 4, 30)))))
    assert not made


def test_similar_pairs_at_the_threshold(spark):
    """Just above 0.8 nearly all pairs are found, and just below none is: sets decide, not bits."""
    base = prose(34, 300, 220)
    above = [(10_000 + i, _apart(t.split(), 4, f"x{i}n")) for i, t in enumerate(base[:150])]
    below = [(10_000 + i, _apart(t.split(), 6, f"x{i}n")) for i, t in enumerate(base) if i >= 150]
    assert 0.8 < _jaccard(base[0], above[0][1]) < 0.85 and 0.7 < _jaccard(base[150], below[0][1]) < 0.8
    got, found = _linked(spark, list(enumerate(base)) + above + below)
    assert 145 <= found <= 150 and all(got[i] != got[10_000 + i] for i in range(150, 300))


# --- 10 scoring

@pytest.mark.parametrize("size,bucket", [(40, 300), (1 << 21, 1 << 25)])
def test_scores_equal_brute_force(spark, size, bucket):
    """Every word and every pair counts; blocks and buckets of any size give the same."""
    rng = random.Random(15)
    rows = [(i, " ".join(rng.choice(WORD_LIST[:12] if i % 3 else WORD_LIST[8:]) for _ in range(rng.randrange(40)))) for i in range(90)]
    rows += [(100, None), (101, ""), (None, "alpha beta"), (5, rows[5][1]), (102, "zzz " * 5000), (103, prose(16, 1, 3000)[0])]
    labels = [(i, int(i % 3 == 0), 0) for i in range(90)] + [(0, 1, 0), (None, 1, 0)]
    got = Counter((r["id"], r["n_tokens"], round(r["score"], 6)) for r in lm_score.scores(
        docs(spark, rows, extra=True).repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), size, bucket).collect())
    texts = [(t or "").lower().split() for _, t in rows]
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    grams = [lambda t: t, lambda t: list(zip([None, *t], t))]
    known = [{g for t in texts for g in of(t)} for of in grams]

    def model(some):
        counts = [Counter(g for t in some for g in of(t)) for of in grams]
        totals = [sum(c.values()) for c in counts]
        return lambda t: sum(math.log(n + a * len(v)) - math.log(c[g] + a) for c, n, v, a, of in zip(
            counts, totals, known, lm_score.ADDED, grams) for g in of(t)) / 2

    target, background = model([t for (i, _), t in zip(rows, texts) if i in good]), model(texts)
    want = Counter((i, len(t), round((target(t) - background(t)) / len(t) if t else 0.0, 6)) for (i, _), t in zip(rows, texts))
    near = lambda x: sorted((i if i is not None else -1, n, s) for i, n, s in x.elements())
    for a, b in zip(near(got), near(want), strict=True):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) < 3e-6
    assert lm_score.scores(docs(spark, []), spark.createDataFrame([], "doc_id long, quality int")).count() == 0


def test_scores_tell_texts_that_occur_twice(spark):
    """Words beyond the most frequent keep their identity, so a text the corpus holds twice is cheaper in the background."""
    once, twice = prose(17, 120, 60), prose(18, 20, 60)
    rows = list(enumerate(once)) + [(1000 + i, t) for i, t in enumerate(twice + twice)]
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = {r["id"]: r["background_loss"] for r in lm_score.scores(docs(spark, rows), none).collect()}
    assert max(v for i, v in got.items() if i >= 1000) < min(v for i, v in got.items() if i < 1000)
