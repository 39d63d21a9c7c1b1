"""One query per operator over the driver tables, with comparison SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import functions as F

from fluxsieve.llm import (align, centroids, chat, decontaminate, exact_dedup, language, licenses, lm_score, pieces, secrets,
                           simhash, url_filter, warc)
from fluxsieve.llm.common import shared_path, table

#: Where the public tokenizers' files are; nothing of them is kept in the repository.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"

#: The white space of the contracts, as DuckDB spells it.
SQL_WHITE = r"'[\x20\x09-\x0D]+'"


def op1_exact_dedup(spark, folder):
    """Every document with the row that stays for its text."""
    return exact_dedup.decisions(table(spark, folder, "documents")).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


OP1_SQL = f"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), {SQL_WHITE}, ' ', 'g')) AS text_sha256
           FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""


def op2_language_id(spark, folder):
    """Language of every document, learned from labelled documents that are not held out."""
    return language.predictions(table(spark, folder, "documents"))


def op3_warc_revisits(spark, folder):
    """Write one WARC record per page, read the archives back and resolve the revisits."""
    path = shared_path(spark, "warc")
    warc.write(table(spark, folder, "pages"), path)
    return warc.resolve(warc.read(spark, path, payloads=False)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_FIVE = "('0x' || substr(h, {0}, 5))::BIGINT"
_DIGIT = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((({0}) >> {1}) & 31)::INT, 1)"
_BASE32 = " || ".join(_DIGIT.format(_FIVE.format(1 + 5 * i), s) for i in range(8) for s in (15, 10, 5, 0))
OP3_SQL = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
q AS (SELECT page_id, payload_bytes, {_BASE32} AS payload_digest FROM p),
o AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS original FROM q)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM original THEN original END AS refers_to
FROM o
"""

def op4_sentencepiece(spark, folder):
    """Sampled pieces of every document, decoded again."""
    return pieces.encoded(table(spark, folder, "documents"), PIECE_MODEL).withColumnRenamed("id", "doc_id")


def op5_secret_scan(spark, folder):
    """Secrets of every document: pattern spans, and those the character models add."""
    found = secrets.spans(table(spark, folder, "documents"))
    count = lambda rank: F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")
    return found.select(
        F.col("id").alias("doc_id"), *[count(i).alias(f"n_{k}") for i, k in enumerate(secrets.KINDS)],
        F.sha2(secrets.named(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        secrets.named(F.col("spans")).alias("spans"))


def _sql_spans(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
    quoted = pattern.replace("'", "''")
    return f"""
  SELECT doc_id, {rank} AS rank, s AS start, s + length(w) AS stop, w FROM (
    SELECT doc_id, w, v, sum(length(piece)) OVER o + coalesce(sum(length(w)) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s
    FROM (SELECT doc_id, i, whole[i] AS w, part[i] AS v, between[i] AS piece FROM (
      SELECT doc_id, whole, part, between, unnest(range(1, len(whole) + 1)) AS i FROM (
        SELECT doc_id, regexp_extract_all(text, '{quoted}', 0) AS whole, regexp_extract_all(text, '{quoted}', {group}) AS part,
               regexp_split_to_array(text, '{quoted}') AS between FROM d)))
    WINDOW o AS (PARTITION BY doc_id ORDER BY i)) WHERE length(v) >= {least}"""


_BASE = "\n  UNION ALL ".join(_sql_spans(k, i, secrets.PATTERNS[k], 2 if k == "assign" else 0, secrets.LEAST[k])
                               for i, k in enumerate(secrets.KINDS))
_NAMED = ("string_agg(['assign', 'access', 'hex', 'markov'][rank + 1] || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' "
          "ORDER BY start, rank)")
OP5_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
base AS ({_BASE}),
run AS (SELECT r.*, EXISTS (SELECT 1 FROM base b WHERE b.doc_id = r.doc_id AND b.start < r.stop AND r.start < b.stop) AS labelled
        FROM ({_sql_spans("run", len(secrets.KINDS), secrets.RUN, 0, 0)}) r),
pair AS (SELECT doc_id, start, labelled, substr(w, i, 2) AS p FROM (SELECT *, unnest(range(1, length(w))) AS i FROM run)),
seen AS (SELECT p, count(*) FILTER (labelled) AS c1, count(*) FILTER (NOT labelled) AS c0 FROM pair GROUP BY 1),
total AS (SELECT p, c1, c0, sum(c1) OVER a AS t1, sum(c0) OVER a AS t0, sum(c1) OVER () AS any1 FROM seen WINDOW a AS (PARTITION BY substr(p, 1, 1))),
ratio AS (SELECT p, CASE WHEN any1 = 0 THEN 0 ELSE round(1000 * ln(((c1 + 1) / (t1 + {secrets._SIZE})) / ((c0 + 1) / (t0 + {secrets._SIZE})))) END AS r FROM total),
added AS (SELECT doc_id, start FROM pair JOIN ratio USING (p) WHERE NOT labelled GROUP BY 1, 2
          HAVING sum(r) >= {secrets.LEAST_RATIO} * count(*)),
every AS (SELECT doc_id, rank, start, stop FROM base UNION ALL
          SELECT r.doc_id, r.rank, r.start, r.stop FROM run r JOIN added a ON r.doc_id = a.doc_id AND r.start = a.start),
out AS (SELECT doc_id, {_NAMED} AS spans, {_NAMED} FILTER (rank < 3) AS base, count(*) FILTER (rank = 0) AS n_assign,
               count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex FROM every GROUP BY 1)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN out USING (doc_id)
"""


def op6_preference_chat(spark, folder):
    """Prompt and masked completions of neighbouring conversations."""
    found = chat.preferences(chat.neighbours(table(spark, folder, "conversations")))
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias(c)
    return found.select("pair_id", "chosen_id", "rejected_id", "n_shared", "prompt", "chosen", "rejected",
                        spans("chosen_mask"), spans("rejected_mask"))


OP6_SQL = r"""
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role,
                  replace(coalesce(text, ''), '<|', '< |') AS text FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT *, conv_id // 2 AS pair_id, conv_id % 2 AS side,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p FROM t),
sizes AS (SELECT pair_id, max(p) FILTER (side = 0) AS c, max(p) FILTER (side = 1) AS r,
                 max(conv_id) FILTER (side = 0) AS chosen_id, max(conv_id) FILTER (side = 1) AS rejected_id
          FROM n GROUP BY 1),
same AS (SELECT a.pair_id, min(a.p) FILTER (a.role <> b.role OR a.text <> b.text) AS d
         FROM n a JOIN n b ON a.pair_id = b.pair_id AND a.p = b.p AND a.side = 0 AND b.side = 1 GROUP BY 1),
k AS (SELECT sizes.*, coalesce(d - 1, least(c, r), 0) AS n_shared
      FROM sizes LEFT JOIN same USING (pair_id)),
e AS (SELECT n.*, n_shared, '<|im_start|>' || role || chr(10) AS head, '<|im_end|>' || chr(10) AS tail
      FROM n JOIN k USING (pair_id)),
f AS (SELECT *, head || text || tail AS body, sum(CASE WHEN p > n_shared THEN length(head || text || tail) END)
             OVER (PARTITION BY pair_id, side ORDER BY p) AS stop FROM e),
m AS (SELECT pair_id,
             coalesce(string_agg(body, '' ORDER BY p) FILTER (side = 0 AND p <= n_shared), '') AS prompt,
             string_agg(body, '' ORDER BY p) FILTER (side = 0 AND p > n_shared) AS chosen,
             string_agg(body, '' ORDER BY p) FILTER (side = 1 AND p > n_shared) AS rejected,
             string_agg((stop - length(text || tail)) || ':' || stop, ',' ORDER BY p)
               FILTER (side = 0 AND p > n_shared AND role = 'assistant') AS chosen_mask,
             string_agg((stop - length(text || tail)) || ':' || stop, ',' ORDER BY p)
               FILTER (side = 1 AND p > n_shared AND role = 'assistant') AS rejected_mask
      FROM f GROUP BY 1)
SELECT pair_id, chosen_id, rejected_id, n_shared, prompt,
       CASE WHEN c IS NOT NULL THEN coalesce(chosen, '') END AS chosen,
       CASE WHEN r IS NOT NULL THEN coalesce(rejected, '') END AS rejected,
       CASE WHEN c IS NOT NULL THEN coalesce(chosen_mask, '') END AS chosen_mask,
       CASE WHEN r IS NOT NULL THEN coalesce(rejected_mask, '') END AS rejected_mask
FROM k JOIN m USING (pair_id)
"""


def op7_url_filter(spark, folder):
    """Verdict on every page's url."""
    return url_filter.verdicts(table(spark, folder, "pages")).withColumn("share", F.round("share", 9))


def _sql_rule(column: str) -> str:
    cases = [f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h + p if column == 'rule' else d}'"
             for d, h, p in sorted(url_filter.RULES, key=lambda r: -len(r[1] + r[2]))]
    return "CASE " + " ".join(cases) + " END"


def _sql_level(i: int) -> str:
    m = url_filter.SMOOTHING
    return f"""
a{i} AS (SELECT *, template[{i + 1}] AS segment FROM t{i}),
b{i} AS (SELECT host, merged, segment, sum(labelled) AS li, sum(blocked) AS bi FROM a{i} WHERE segment IS NOT NULL GROUP BY ALL),
n{i} AS (SELECT *, sum(li) OVER w AS n, sum(bi) OVER w AS b, count(*) OVER w AS branches FROM b{i} WINDOW w AS (PARTITION BY host, merged)),
m{i} AS (SELECT host, merged, segment, n, b, CASE WHEN branches = 1 OR coalesce(
           abs(bi / nullif(li, 0) - (b - bi) / nullif(n - li, 0)) > {url_filter.Z} * sqrt(
             b / nullif(n, 0) * (1 - b / nullif(n, 0)) * (1 / nullif(li, 0) + 1 / nullif(n - li, 0))), false)
           THEN segment ELSE '*' END AS branch FROM n{i}),
g{i} AS (SELECT a.host, a.template, labelled, blocked, share, n, b, branch,
                CASE WHEN branch IS NULL THEN a.merged ELSE list_append(a.merged, branch) END AS merged
         FROM a{i} a LEFT JOIN m{i} m ON a.host = m.host AND a.merged = m.merged AND a.segment = m.segment),
t{i + 1} AS (SELECT host, template, labelled, blocked, merged,
                CASE WHEN branch IS NULL OR (sum(labelled) OVER w = n AND sum(blocked) OVER w = b) THEN share
                     ELSE (sum(blocked) OVER w + {m} * share) / (sum(labelled) OVER w + {m}) END AS share
             FROM g{i} WINDOW w AS (PARTITION BY host, merged, branch IS NULL))"""


#: The comparison grows trees this deep: more than any path of the tables has segments.
SQL_LEVELS = 6
OP7_SQL = f"""
WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                  regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
v AS (SELECT *, {_sql_rule("rule")} AS rule, {_sql_rule("verdict")} AS ruling, list_filter(string_split(path, '/'), lambda x: x <> '') AS own FROM u),
p AS (SELECT page_id, host, path, rule, ruling, list_transform(own,
        lambda x: CASE WHEN regexp_matches(x, '{url_filter.VARIABLE}') THEN '*' ELSE x END) AS template FROM v),
leaves AS (SELECT host, template, count(ruling) AS labelled, count(*) FILTER (ruling = 'block') AS blocked FROM p GROUP BY ALL),
prior AS (SELECT coalesce(sum(blocked) / nullif(sum(labelled), 0), 0) AS prior FROM leaves),
t0 AS (SELECT host, template, labelled, blocked, []::VARCHAR[] AS merged,
         (sum(blocked) OVER w + {url_filter.SMOOTHING} * prior) / (sum(labelled) OVER w + {url_filter.SMOOTHING}) AS share
       FROM leaves, prior WINDOW w AS (PARTITION BY host)),{",".join(_sql_level(i) for i in range(SQL_LEVELS))}
SELECT page_id, p.host, path, rule, coalesce(ruling, CASE WHEN share >= {url_filter.REJECT} THEN 'block' ELSE 'allow' END) AS verdict,
       '/' || array_to_string(merged, '/') AS template, round(share, 9) AS share
FROM p LEFT JOIN t{SQL_LEVELS} t ON p.host = t.host AND p.template = t.template
"""


def op8_decontamination(spark, folder):
    """Words of every document that lie in a window of a benchmark item."""
    found = decontaminate.decisions(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


_WORDS = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
OP8_SQL = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes)),
hit AS (SELECT dw.doc_id, dw.i, dw.k, bw.item_id FROM dw JOIN bw USING (k, g)),
words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY 1),
items AS (SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS l FROM hit GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_hit, coalesce(len(l), 0) AS n_items,
       sha256(coalesce(array_to_string(l, ','), '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def op9_simhash_near_dedup(spark, folder):
    """Fingerprint and component of every document."""
    return simhash.components(table(spark, folder, "documents"), size=3).select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_cross_entropy_difference(spark, folder):
    """Score of every document: target loss minus background loss per token."""
    found = lm_score.scores(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.select(F.col("id").alias("doc_id"), "n_tokens", *[
        F.round(c, 6).alias(c) for c in ("target_loss", "background_loss", "score")])


def _sql_loss(prefix: str, good: str) -> str:
    """Mean loss of a token: half that of its word, half that of its pair, each with added counts over all of its order."""
    parts = [f"(ln({good}_total + {a} * {v}) - ln({c}.{good} + {a}))" for a, v, c in zip(lm_score.ADDED, ("words", "pairs"), ("w", "p"))]
    return f"avg(({' + '.join(parts)}) / 2) AS {prefix}"


OP10_SQL = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS row, doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS is_good,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x20\x09-\x0D]+') AS t FROM documents),
each AS (SELECT row, coalesce(is_good, false) AS is_good, t[i] AS word, CASE WHEN i > 1 THEN t[i - 1] END AS before
         FROM (SELECT *, unnest(range(1, len(t) + 1)) AS i FROM d)),
word AS (SELECT word, count(*) AS everything, count(*) FILTER (is_good) AS good FROM each GROUP BY 1),
pair AS (SELECT before, word, count(*) AS everything, count(*) FILTER (is_good) AS good FROM each GROUP BY 1, 2),
total AS (SELECT count(*) AS everything_total, count(*) FILTER (is_good) AS good_total, (SELECT count(*) FROM word) AS words,
                 (SELECT count(*) FROM pair) AS pairs FROM each),
score AS (SELECT row, count(*) AS n, {_sql_loss("tl", "good")}, {_sql_loss("bl", "everything")}
          FROM each JOIN word w ON each.word = w.word JOIN pair p ON each.word = p.word AND each.before IS NOT DISTINCT FROM p.before, total GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_tokens, round(coalesce(tl, 0), 6) AS target_loss, round(coalesce(bl, 0), 6) AS background_loss,
       round(coalesce(tl - bl, 0), 6) AS score FROM d LEFT JOIN score USING (row)
"""


def op11_centroid_clustering(spark, folder):
    """Cluster of every vector, with the sums of distances."""
    found, _ = centroids.clusters(table(spark, folder, "embeddings"))
    return found.withColumnRenamed("id", "vec_id")


def _sql_assigned(i: int) -> str:
    return f"""
a{i} AS (SELECT vec_id, row, q, cluster, distance FROM (
  SELECT vec_id, row, q, cluster, list_sum(list_transform(range(1, {centroids.DIMENSIONS + 1}), lambda i: (q[i] - c[i]) * (q[i] - c[i]))) AS distance
  FROM kept, c{i}) QUALIFY row_number() OVER (PARTITION BY row ORDER BY distance, cluster) = 1)"""


def _sql_moved(i: int) -> str:
    return f"""
s{i} AS (SELECT cluster, i, sum(x)::BIGINT AS s, count(*) AS n FROM (
  SELECT cluster, unnest(range(1, {centroids.DIMENSIONS + 1})) AS i, unnest(q) AS x FROM a{i}) GROUP BY ALL),
m{i} AS (SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM s{i} GROUP BY 1),
c{i + 1} AS (SELECT cluster, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (cluster))"""


OP11_SQL = f"""
WITH kept AS (SELECT vec_id, row_number() OVER () AS row, list_transform(embedding, lambda x: floor({centroids.SCALE} * x::DOUBLE)::BIGINT) AS q FROM embeddings
              WHERE len(embedding) = {centroids.DIMENSIONS} AND len(list_filter(embedding, lambda x: isfinite(x))) = {centroids.DIMENSIONS}),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('{centroids.SEED}:' || vec_id)) - 1 AS cluster, q AS c FROM kept
       QUALIFY cluster < {centroids.CLUSTERS}),{",".join(_sql_assigned(i) + "," + _sql_moved(i) for i in range(centroids.ROUNDS))},{_sql_assigned(centroids.ROUNDS)}
SELECT vec_id, a.cluster, distance, sum(distance) OVER (PARTITION BY a.cluster) AS cluster_inertia, sum(distance) OVER () AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{centroids.ROUNDS} a JOIN c{centroids.ROUNDS} c ON a.cluster = c.cluster
"""


def op12_tokenizer_alignment(spark, folder):
    """Groups, links and link counts of two tokenizers' tokens over every document."""
    return align.aligned(table(spark, folder, "documents"), BYTE_BPE, PIECE_MODEL).withColumnRenamed("id", "doc_id")


def op13_license_scan(spark, folder):
    """Licenses of every document: the required phrases, and what the rules add."""
    found = licenses.labelled(table(spark, folder, "documents"))
    base = F.filter("found", lambda d: d["rule"] < len(licenses.BASE))
    start = F.transform(base, lambda d: d["start"])
    names = F.array_sort(F.array_distinct(F.transform(base, lambda d: d["label"])))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(start).alias("first_word"),
        F.array_max(start).alias("last_word"), F.array_join(names, ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score")


_RULES = ",\n".join(
    f"({i}, '{r.label}', {r.weight}, '{r.keyword}', '{r.pattern}')" for i, r in enumerate(licenses.rules()))
OP13_SQL = rf"""
WITH rule(rule, label, weight, keyword, pattern) AS (VALUES {_RULES}),
d AS (SELECT doc_id, row_number() OVER () AS row, coalesce({_WORDS}, []) AS w FROM documents),
t AS (SELECT row, ' ' || array_to_string(w, '  ') || ' ' AS t FROM d WHERE len(w) > 0),
tried AS (SELECT row, rule, t, pattern FROM t JOIN rule ON contains(t, keyword)),
parts AS (SELECT row, rule, regexp_extract_all(t, pattern) AS whole, regexp_split_to_array(t, pattern) AS between FROM tried),
each AS (SELECT row, rule, i, whole[i] AS m, between[i] AS b FROM (SELECT *, unnest(range(1, len(whole) + 1)) AS i FROM parts)),
-- each word has two blanks: those before a match, halved, are the words before it
found AS (SELECT row, rule, (sum(blanks(b)) OVER o + coalesce(sum(blanks(m)) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) // 2 AS s,
                 blanks(m) // 2 AS n FROM each WINDOW o AS (PARTITION BY row, rule ORDER BY i)),
kept AS (SELECT f.row, f.rule, f.s, label, weight FROM found f JOIN rule USING (rule) WHERE f.rule < {len(licenses.BASE)} OR NOT EXISTS (
           SELECT 1 FROM found e WHERE e.row = f.row AND e.rule < f.rule AND e.s <= f.s AND e.s + e.n >= f.s + f.n)),
out AS (SELECT row, count(*) FILTER (rule < {len(licenses.BASE)}) AS n_base, min(s) FILTER (rule < {len(licenses.BASE)}) AS first_word,
               max(s) FILTER (rule < {len(licenses.BASE)}) AS last_word, max(weight) AS score,
               list_sort(list(DISTINCT label) FILTER (rule < {len(licenses.BASE)})) AS base_labels, list_sort(list(DISTINCT label)) AS labels
        FROM kept GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(array_to_string(base_labels, ','), '') AS base_labels, coalesce(array_to_string(labels, ','), '') AS labels,
       CAST(coalesce(score, 0) AS DOUBLE) AS score FROM d LEFT JOIN out USING (row)
"""
for _text in ("b", "m"):
    OP13_SQL = OP13_SQL.replace(f"blanks({_text})", f"(length({_text}) - length(replace({_text}, ' ', '')))")


QUERIES = {
    "op1_exact_dedup": (op1_exact_dedup, OP1_SQL),
    "op2_language_id": (op2_language_id, None),
    "op3_warc_revisits": (op3_warc_revisits, OP3_SQL),
    "op4_sentencepiece": (op4_sentencepiece, None),
    "op5_secret_scan": (op5_secret_scan, OP5_SQL),
    "op6_preference_chat": (op6_preference_chat, OP6_SQL),
    "op7_url_filter": (op7_url_filter, OP7_SQL),
    "op8_decontamination": (op8_decontamination, OP8_SQL),
    "op9_simhash_near_dedup": (op9_simhash_near_dedup, None),
    "op10_cross_entropy_difference": (op10_cross_entropy_difference, OP10_SQL),
    "op11_centroid_clustering": (op11_centroid_clustering, OP11_SQL),
    "op12_tokenizer_alignment": (op12_tokenizer_alignment, None),
    "op13_license_scan": (op13_license_scan, OP13_SQL),
}
