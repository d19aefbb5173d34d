"""SQL twins of the operators that SQL can say, for another engine over the same tables."""

from __future__ import annotations

from .hostrules import Limits
from .mixing import STEPS

BLANK = r"[^\x20\x09-\x0D]"


def topk(k: int = 20, every: int = 20, scale: int = 64) -> str:
    return f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % {every} = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= {k}"""


def quality_rules(m: Limits = Limits()) -> str:
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, lower(coalesce(source, '')) AS host FROM documents),
w AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
      FROM (SELECT doc_id, regexp_extract_all(text, '{BLANK}+') AS ws FROM d)),
win AS (SELECT doc_id, i, w, lead(w) OVER p AS b, lead(w, 2) OVER p AS c FROM w WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
starts AS (SELECT doc_id, i, c IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, w, b, c) > 1 AS again FROM win),
covered AS (SELECT doc_id, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS again FROM starts),
words AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (again) AS n_repeat_words FROM covered GROUP BY doc_id),
chars AS (SELECT doc_id, sum(length(w)) AS word_chars FROM w GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
          FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{BLANK}') GROUP BY doc_id),
stats AS (
  SELECT d.doc_id, host, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
  FROM d LEFT JOIN words USING (doc_id) LEFT JOIN chars USING (doc_id) LEFT JOIN lines USING (doc_id)),
rules AS (
  SELECT *, n_words < {m.min_words} OR 100 * n_repeat_words > {m.repeat_percent} * n_words AS base_failed,
    100 * n_symbols > {m.symbol_percent} * n_words OR 100 * n_dup_lines > {m.dup_line_percent} * n_lines AS more_failed FROM stats),
hosts AS (SELECT host, count(*)::DOUBLE AS n, (count(*) FILTER (base_failed OR more_failed))::DOUBLE AS f FROM rules GROUP BY host),
prior AS (SELECT sum(f) / sum(n) AS mean, sum(n) AS n, count(*) AS k FROM hosts),
spread AS (SELECT mean, (sum(hosts.n * pow(f / hosts.n - mean, 2)) - (any_value(k) - 1) * mean * (1 - mean)) / any_value(prior.n) AS between_
           FROM hosts, prior GROUP BY mean),
weight AS (SELECT mean, CASE WHEN between_ > 0 THEN least(greatest(mean * (1 - mean) / between_ - 1, 1.0), 1e6) ELSE 1e6 END AS weight FROM spread),
rates AS (SELECT host, (f + mean * weight) / (n + weight) AS rate FROM hosts, weight)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT more_failed AND rate < {m.host_rate} AS kept, host, round(rate, 6) AS host_rate
FROM rules JOIN rates USING (host)"""


def mixing(entropy: float = 0.97, repetition: float = 2.0, seed: int = 7) -> str:
    hash_ = lambda *parts: "('0x' || substr(md5('" + str(seed) + "' " + " ".join(f"|| ':' || {p}" for p in parts) + "), 1, 15))::BIGINT"
    levels = []
    for k in range(STEPS // 6):
        levels.append(f"""
p{k} AS (
  SELECT low, width, i, low + width * i AS e FROM (SELECT low, (high - low) / 64 AS width FROM r{k}), range(1, 64) t(i)),
h{k} AS (
  SELECT low, width, i, ln(sum(pow(share, e))) - e * sum(pow(share, e) * ln(share)) / sum(pow(share, e)) AS h,
    pow(max(share) / min(share), 1 - e) AS r, count(*) AS n FROM p{k}, shares GROUP BY low, width, i, e),
s{k} AS (
  SELECT any_value(low) AS low, any_value(width) AS width,
    greatest(count(*) FILTER (r > {repetition}), count(*) FILTER (h >= {entropy} * ln(n))) AS step FROM h{k}),
r{k + 1} AS (SELECT low + width * step AS low, low + width * (step + 1) AS high FROM s{k})""")
    return f"""
WITH docs AS (
  SELECT doc_id, source, coalesce(source, '') AS src, greatest(1, ceil(strlen(coalesce(text, '')) / 4))::BIGINT AS tokens,
    {hash_("coalesce(doc_id::VARCHAR, '')")} AS turn FROM documents),
cut AS (SELECT *, (turn >> 52)::INTEGER AS block FROM docs),
totals AS (SELECT src, sum(tokens) AS total FROM cut GROUP BY src),
shares AS (SELECT src, total, total / (SELECT sum(total) FROM totals)::DOUBLE AS share FROM totals),
r0 AS (SELECT 0.0::DOUBLE AS low, 1.0::DOUBLE AS high),{",".join(levels)},
last AS (SELECT CASE WHEN (SELECT count(*) FROM shares) < 2 THEN 1.0
  WHEN (SELECT pow(max(share) / min(share), 1 - any_value(low)) FROM shares) > {repetition} THEN any_value(high) ELSE any_value(low) END AS e FROM r{STEPS // 6}),
weights AS (SELECT src, total, pow(share, (SELECT e FROM last)) AS w FROM shares),
size AS (SELECT ceil(max(total / w) * sum(w)) AS budget, sum(w) AS z FROM weights),
wanted AS (SELECT src, total, least(floor(w / z * budget + 1e-3), floor(total * {repetition}))::BIGINT AS want FROM weights, size),
plan AS (SELECT src, (want // total)::INTEGER AS epochs, (want % total)::BIGINT AS rest FROM wanted),
placed AS (SELECT cut.*, epochs, rest, {hash_("src", "epochs", "block")} AS last_turn FROM cut JOIN plan USING (src)),
summed AS (SELECT *, sum(tokens) OVER (PARTITION BY src ORDER BY last_turn, block, turn) AS running FROM placed),
copies AS (SELECT *, epochs + (running <= rest)::INTEGER AS copies FROM summed),
many AS (SELECT *, unnest(range(0, copies))::INTEGER AS epoch FROM copies)
SELECT doc_id, source, tokens, epoch, block, {hash_("src", "epoch", "block")} AS block_turn,
  {hash_("coalesce(doc_id::VARCHAR, '')", "epoch")} AS turn FROM many"""



def crc32(text: str) -> str:
    """The unsigned crc32 of a text's UTF-8 bytes, bit by bit."""
    byte = f"('0x' || substr(hex(encode({text})), 2 * i::INTEGER - 1, 2))::BIGINT"
    bits = "list_reduce([xor(crc, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, b: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END))"
    ones = "4294967295::BIGINT"
    return f"xor(list_reduce(list_transform(range(1, strlen({text}) + 1), lambda i: {byte}), lambda crc, x: {bits}, {ones}), {ones})"


def merkle(every: int = 7) -> str:
    encoded = lambda c: f"coalesce(strlen(({c})::VARCHAR) || ':' || ({c})::VARCHAR, '-')"
    leaf = lambda n: "sha256(" + " || ".join(encoded(c) for c in ("doc_id", "source", "lang", n, "text")) + ")"

    def nodes(name: str, base: str) -> str:
        return f"""{name} AS ({base} UNION ALL
  SELECT tree, level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY idx)) FROM {name} WHERE n > 1 GROUP BY tree, level, idx // 2, n)"""

    def way(name: str, base: str, of: str) -> str:
        return f"""{name} AS ({base} UNION ALL
  SELECT row, f.tree, f.level + 1, f.idx // 2, (f.n + 1) // 2,
    sha256(CASE WHEN s.digest IS NULL THEN acc WHEN f.idx % 2 = 1 THEN s.digest || acc ELSE acc || s.digest END), proof || coalesce(s.digest, '')
  FROM {name} f LEFT JOIN {of} s ON s.tree = f.tree AND s.level = f.level AND s.idx = xor(f.idx, 1::BIGINT) WHERE f.n > 1)"""
    return f"""
WITH RECURSIVE l AS (
  SELECT doc_id, lang, {leaf("n_chars")} AS leaf,
    {leaf(f"n_chars + CASE WHEN {crc32('doc_id::VARCHAR')} % {every} = 0 THEN 1 ELSE 0 END")} AS given FROM documents),
d AS (
  SELECT *, row_number() OVER () AS row, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY lang) AS n,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM l),
{nodes("low", "SELECT tree, 0 AS level, idx, n, leaf AS digest FROM d")},
{nodes("high", "SELECT -1::BIGINT AS tree, 0 AS level, tree AS idx, count(*) OVER () AS n, digest FROM low WHERE n = 1")},
{way("up", "SELECT row, tree, 0 AS level, idx, n, coalesce(given, leaf) AS acc, '' AS proof FROM d", "low")},
{way("over", "SELECT row, -1::BIGINT AS tree, 0 AS level, tree AS idx, (SELECT count(*) FROM low WHERE n = 1) AS n, acc, proof FROM up WHERE n = 1", "high")}
SELECT doc_id, leaf, low.digest AS subroot, high.digest AS root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = high.digest AS verified
FROM d JOIN over USING (row) JOIN low ON low.tree = d.tree AND low.n = 1 JOIN high ON high.n = 1 WHERE over.n = 1"""


def spelling(every: int = 199, ratio: int = 5, min_length: int = 6, min_count: int = 5) -> str:
    h = crc32("doc_id || ':' || run")
    return f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
low AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM runs),
each AS (SELECT doc_id, run, count(*) AS times FROM low WHERE length(run) >= {min_length} GROUP BY ALL),
hashed AS (SELECT run, times, {h} AS h FROM each),
slipped AS (SELECT CASE WHEN h % {every} = 0 THEN substr(run, 1, (h % length(run))::INTEGER) || substr(run, (h % length(run))::INTEGER + 2) ELSE run END AS word, times FROM hashed),
words AS (SELECT word, sum(times)::BIGINT AS n FROM slipped WHERE length(word) >= {min_length} GROUP BY word HAVING sum(times) >= {min_count}),
cut AS (SELECT word, n, i, substr(word, 1, i - 1) || '$' || substr(word, i + 1) AS hole, substr(word, 1, i - 1) || substr(word, i + 1) AS less
        FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INTEGER AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.hole = b.hole AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.less = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.less = b.word),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, encode(other)) AS other, max(other_n) AS other_n FROM pairs GROUP BY word),
forms AS (SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN other_n >= {ratio} * n THEN other END AS form,
  CASE WHEN other_n >= {ratio} * n THEN other_n END AS form_n FROM words LEFT JOIN best USING (word)),
follow AS (SELECT word, word AS root, form AS next FROM forms
  UNION ALL SELECT follow.word, forms.word, forms.form FROM follow JOIN forms ON follow.next = forms.word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN (SELECT word, root FROM follow WHERE next IS NULL) USING (word)"""
