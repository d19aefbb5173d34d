"""The registered queries once more, as plain SQL over the same tables, for another engine to check.

Statements are put together from named building blocks (WITH clauses).
"""

from __future__ import annotations

import re

from .. import values as V
from ..functions import text as X
from . import bindings as T

SPACE = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\p{Z}]"
NOT_SPACE = r"[^\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\p{Z}]"
CONTROL = r"[\x{00}-\x{08}\x{0b}\x{0c}\x{0e}-\x{1f}\x{7f}\x{fffd}]"
WORD = r"\p{L}\p{N}_"
TOKEN = r"[\p{L}\p{N}_](?:[\p{L}\p{N}_']*[\p{L}\p{N}_])?"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# ---------------------------------------------------------------- scalar snippets
def control(x):
    return f"regexp_replace({x}, '{CONTROL}', '', 'g')"


def spaces(x):
    return f"coalesce(trim(regexp_replace({x}, '{SPACE}+', ' ', 'g')), '')"


def customer(x, handle=T.HANDLE):
    return rf"trim(regexp_replace({spaces(control(x))}, '(?i)^{handle}\s*', ''))"


def reply(x):
    return rf"trim(regexp_replace({spaces(control(x))}, '^@[{WORD}]+\s*', ''))"


def words(x):
    return f"coalesce(len(regexp_extract_all({x}, '{NOT_SPACE}+')), 0)"


def keyword(x, ws):
    escaped = "|".join(re.sub(r"([.^$*+?{}\[\]\\|()\-])", r"\\\1", w) for w in ws)
    return f"coalesce(regexp_matches(lower({x}), {q(f'(^|[^{WORD}])(?:{escaped})($|[^{WORD}])')}), false)"


def first(x, dictionary=T.KEYWORDS, default=T.DEFAULT):
    return "CASE " + " ".join(f"WHEN {keyword(x, ws)} THEN '{i}'" for i, ws in dictionary) + f" ELSE '{default}' END"


def matches(x, dictionary=T.KEYWORDS):
    items = ", ".join(f"CASE WHEN {keyword(x, ws)} THEN '{i}' END" for i, ws in dictionary)
    return f"list_filter([{items}], lambda z: z IS NOT NULL)"


def two(x):
    return f"printf('%.2f', round({x}, 2))"


def ngrams(tokens, low, high):
    sizes = []
    for n in range(low, high + 1):
        parts = " || ' ' || ".join(f"{tokens}[i + {j}]" for j in range(n))
        sizes.append(f"[{parts} FOR i IN range(1, greatest(len({tokens}) - {n - 2}, 1))]")
    out = sizes[0]
    for s in sizes[1:]:
        out = f"list_concat({out}, {s})"
    return out


def char_wb(x, low, high):
    grams = (f"flatten(list_transform(range({low}, least({high}, greatest(length(w) + 2, {low})) + 1), lambda n: "
             "list_transform(range(1, greatest(length(w) + 2 - n + 1, 1) + 1), "
             "lambda i: substring(' ' || w || ' ', i, n))))")
    return f"flatten(list_transform(regexp_extract_all(lower({x}), '{NOT_SPACE}+'), lambda w: {grams}))"


def contains_any(x, phrases):
    return "(" + " OR ".join(f"contains({x}, {q(p)})" for p in phrases) + ")"


def draw(seed, key):
    return f"md5('{seed}:' || {key})"


# ---------------------------------------------------------------- WITH blocks
def messages(many=False, name="tweets"):
    brand = "'Brand' || (conv_id % 5)" if many else f"'{T.BRAND}'"
    number = lambda t: f"CASE WHEN {t} < 100 THEN conv_id * 100 + {t} + 1 ELSE {1 << 52} + conv_id * {1 << 24} + {t} - 100 END"
    return f"""{name} AS (SELECT {number('turn')} AS tweet_id,
      CASE role WHEN 'assistant' THEN {brand} WHEN 'user' THEN 'u' || conv_id ELSE 'SystemBot' END AS author_id,
      role = 'user' AS inbound,
      strftime(TIMESTAMP '2017-10-31 22:08:27' + (conv_id * 100 + turn + 1) * INTERVAL 1 MINUTE,
               '%a %b %d %H:%M:%S +0000 %Y') AS created_at,
      CASE role WHEN 'user' THEN '@' || {brand} || ' ' || text WHEN 'assistant' THEN '@u' || conv_id || ' ' || text
           ELSE text END AS text,
      CASE WHEN role = 'user' THEN CAST({number('(turn + 1)')} AS VARCHAR) END AS response_tweet_id,
      CASE WHEN turn > 0 THEN CAST({number('(turn - 1)')} AS DOUBLE) END AS in_response_to_tweet_id
      FROM conversations)"""


TWEETS = messages()
MANY = messages(True)
SUBSET = f"""subset AS (SELECT * FROM tweets WHERE (NOT inbound AND lower(author_id) = '{T.BRAND.lower()}')
      OR (inbound AND contains(lower(text), '{T.HANDLE.lower()}')))"""


def links(source):
    return f"""links AS (SELECT tweet_id, CAST(in_response_to_tweet_id AS BIGINT) AS parent_id,
      CASE WHEN NOT inbound OR lower(author_id) = '{T.BRAND.lower()}' THEN 'brand' ELSE 'customer' END AS role
      FROM {source})"""


KIDS = """kids AS (SELECT parent_id, min(tweet_id) AS first_child, count(*) AS replies FROM links
      WHERE parent_id IS NOT NULL GROUP BY parent_id)"""
ROOTS = """roots AS (SELECT * FROM links l WHERE parent_id IS NULL
      OR NOT EXISTS (SELECT 1 FROM links p WHERE p.tweet_id = l.parent_id))"""
CHAINS = """chains(root_tweet_id, turn_index, tweet_id, role) AS (
      SELECT tweet_id, CAST(1 AS BIGINT), tweet_id, role FROM roots WHERE role = 'customer'
      UNION ALL SELECT c.root_tweet_id, c.turn_index + 1, l.tweet_id, l.role
      FROM chains c JOIN kids k ON k.parent_id = c.tweet_id JOIN links l ON l.tweet_id = k.first_child)"""


def sizes(min_turns):
    return f"""sizes AS (SELECT root_tweet_id, count(*) AS turn_count, count(*) FILTER (role = 'brand') AS brand_turns
      FROM chains GROUP BY root_tweet_id HAVING count(*) >= {min_turns} AND count(*) FILTER (role = 'brand') > 0)"""


TURNS = f"""turns AS MATERIALIZED (SELECT c.root_tweet_id, c.turn_index, c.tweet_id, t.author_id, c.role, t.text,
      CASE WHEN c.role = 'brand' THEN {reply('t.text')} ELSE {customer('t.text')} END AS cleaned_text, t.created_at,
      CAST(t.in_response_to_tweet_id AS BIGINT) AS in_response_to_tweet_id
      FROM chains c JOIN sizes s USING (root_tweet_id) JOIN subset t ON t.tweet_id = c.tweet_id)"""
THREADS = """threads AS MATERIALIZED (SELECT root_tweet_id,
      min_by(author_id, turn_index) AS customer_author_id, count(*) AS turn_count,
      min_by(text, turn_index) AS customer_initial_issue, min_by(cleaned_text, turn_index) AS customer_cleaned_issue,
      min_by(cleaned_text, turn_index) FILTER (role = 'brand') AS brand_first_response,
      max_by(cleaned_text, turn_index) FILTER (role = 'brand') AS brand_final_resolution,
      bool_or(role = 'brand') AS has_brand_resolution, 'conv_' || root_tweet_id AS conversation_id
      FROM turns GROUP BY root_tweet_id)"""
CORPUS = [TWEETS, SUBSET, links("subset"), KIDS, ROOTS, CHAINS, sizes(2), TURNS, THREADS]

CUSTOMERS = f"customers AS MATERIALIZED (SELECT tweet_id, text, {customer('text')} AS cleaned FROM tweets WHERE inbound)"
TAXONOMY = "taxonomy(priority, name, display_name, risk_level, default_action, examples) AS (VALUES " + ", ".join(
    f"({i}, {q(n)}, {q(dn)}, {q(r)}, {q(a)}, {q(' '.join(ex))})"
    for i, (n, dn, r, a, ex) in enumerate(T.TAXONOMY, start=1)) + ")"


def golden(per_intent, ambiguous, target, name="golden"):
    p = name
    order = draw(42, "conversation_id") + ", conversation_id"
    shape = ("conversation_id, customer_cleaned_issue, gold_intent, gold_decision, gold_reason, risk_level, "
             "brand_first_response, difficulty, turn_count")
    return [
        f"""{p}_pool AS MATERIALIZED (SELECT *, {matches('customer_cleaned_issue')} AS intents,
          {words('customer_cleaned_issue')} AS n_words
          FROM threads WHERE {words('customer_cleaned_issue')} >= 2 AND coalesce(brand_first_response, '') <> '')""",
        f"""{p}_single AS (SELECT * FROM (SELECT *, intents[1] AS gold_intent,
          row_number() OVER (PARTITION BY intents[1] ORDER BY {order}) AS draw_no
          FROM {p}_pool WHERE len(intents) = 1) WHERE draw_no <= {per_intent})""",
        f"""{p}_labelled AS MATERIALIZED (SELECT s.*, t.priority, t.risk_level,
          CASE WHEN t.risk_level = 'high' THEN '{V.ESCALATE}' ELSE '{V.AUTO}' END AS gold_decision,
          CASE WHEN t.risk_level = 'high' THEN 'High-risk domain (' || display_name
            || '): requires human verification or hardware/billing authorization.'
            ELSE 'Standard ' || display_name || ' inquiry: safe to provide official troubleshooting guidance.'
            END AS gold_reason,
          CASE WHEN n_words < 6 THEN 'hard' WHEN n_words > 25 OR turn_count > 3 THEN 'medium' ELSE 'easy' END
            AS difficulty
          FROM {p}_single s JOIN taxonomy t ON t.name = s.gold_intent)""",
        f"""{p}_ambiguous AS MATERIALIZED (SELECT *, intents[1] AS gold_intent, '{V.ESCALATE}' AS gold_decision,
          'Multi-issue query touching both ' || intents[1] || ' and ' || intents[2]
            || '; requires human agent triage.' AS gold_reason, 'medium' AS risk_level, 'hard' AS difficulty
          FROM (SELECT * FROM {p}_pool WHERE len(intents) > 1 ORDER BY {order} LIMIT {ambiguous}))""",
        f"""{p}_chosen AS MATERIALIZED (SELECT {shape}, 1 AS step, priority AS stratum FROM {p}_labelled
          UNION ALL SELECT {shape}, 2, 0 FROM {p}_ambiguous)""",
        top_up(f"{p}_topup", f"{p}_pool", f"{p}_chosen", target),
        f"""{p}_all AS (SELECT * FROM {p}_chosen UNION ALL SELECT {shape}, 3, 0 FROM {p}_topup)""",
        f"""{p} AS MATERIALIZED (SELECT printf('gold_%03d', row_number() OVER (ORDER BY step, stratum, {order})) AS id,
          conversation_id, customer_cleaned_issue AS customer_message, customer_cleaned_issue AS conversation_context,
          gold_intent, gold_decision, gold_reason, risk_level, brand_first_response AS reference_resolution,
          difficulty, turn_count FROM {p}_all)""",
    ]


def top_up(name, pool, chosen, target):
    order = draw(42, "conversation_id") + ", conversation_id"
    return f"""{name} AS MATERIALIZED (SELECT *, '{T.DEFAULT}' AS gold_intent, '{V.AUTO}' AS gold_decision,
          'General technical advice request.' AS gold_reason, 'low' AS risk_level, 'medium' AS difficulty
          FROM (SELECT *, row_number() OVER (ORDER BY {order}) AS place FROM {pool} p
                WHERE NOT EXISTS (SELECT 1 FROM {chosen} c WHERE c.conversation_id = p.conversation_id))
          WHERE place <= {target} - (SELECT count(*) FROM {chosen}))"""


GOLDEN = golden(T.PER_INTENT, T.AMBIGUOUS, T.TARGET)
SMALL = golden(*T.SMALL_SET, name="small")


def cases(held_out):
    return f"""cases AS MATERIALIZED (SELECT root_tweet_id AS case_order, conversation_id AS case_id,
      customer_cleaned_issue AS customer_issue, brand_first_response AS brand_resolution,
      customer_cleaned_issue AS conversation_context, {first('customer_cleaned_issue')} AS intent, turn_count
      FROM threads t WHERE NOT EXISTS (SELECT 1 FROM {held_out} g WHERE g.conversation_id = t.conversation_id)
      AND {words('customer_cleaned_issue')} >= 3 AND {words('brand_first_response')} >= 3
      AND lower(customer_cleaned_issue) NOT IN ({", ".join(q(a) for a in V.ACKNOWLEDGEMENTS)}))"""


def term_counts(name, source, doc, text, terms, prepared="tokens"):
    return f"""{name} AS MATERIALIZED (SELECT {doc}, term, count(*) AS tf FROM (
      SELECT {doc}, unnest({terms}) AS term FROM (SELECT {doc}, {text} AS {prepared} FROM {source})) GROUP BY ALL)"""


def fold_tokens(x):
    return f"regexp_extract_all(strip_accents(lower({x})), {q(TOKEN)})"


def vocab(name, counts, cap, documents):
    return f"""{name} AS MATERIALIZED (SELECT *, ln((1.0 + (SELECT count(*) FROM {documents})) / (1.0 + df)) + 1.0 AS idf
      FROM (SELECT term, CAST(sum(tf) AS BIGINT) AS n, count(*) AS df FROM {counts} GROUP BY term
            {"" if cap is None else f"ORDER BY n DESC, term LIMIT {cap}"}))"""


def weights(name, counts, vocabulary, doc):
    return f"""{name} AS MATERIALIZED (SELECT {doc}, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY {doc})) AS weight
      FROM (SELECT {doc}, term, (1.0 + ln(CAST(tf AS DOUBLE))) * idf AS raw FROM {counts} JOIN {vocabulary} USING (term)))"""


INDEX = [
    term_counts("case_terms", "cases", "case_order", fold_tokens("customer_issue"), ngrams("tokens", 1, 3)),
    vocab("case_vocab", "case_terms", None, "cases"),
    weights("postings", "case_terms", "case_vocab", "case_order"),
]


def search(source, key, text, k, intent=None, floor=None):
    """`found`: ranked cases of every query of `source`."""
    allowed = ""
    if intent:
        allowed = f"""WHERE c.intent = s.{intent} OR c.intent IS NULL OR NOT EXISTS (
          SELECT 1 FROM cases o WHERE o.intent = s.{intent} OR o.intent IS NULL)"""
    after = f"WHERE sim >= {floor}" if floor else ""
    return [
        term_counts("query_terms", source, key, fold_tokens(text), ngrams("tokens", 1, 3)),
        weights("query_weights", "query_terms", "case_vocab", key),
        f"""dots AS MATERIALIZED (SELECT {key}, case_order, sum(a.weight * b.weight) AS dot
          FROM query_weights a JOIN postings b USING (term) GROUP BY ALL)""",
        f"""ranked AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY round(sim, 6) DESC, case_order) AS place
          FROM (SELECT s.{key}, c.*, coalesce(d.dot, 0.0) AS sim FROM {source} s CROSS JOIN cases c
                LEFT JOIN dots d ON d.{key} = s.{key} AND d.case_order = c.case_order {allowed}))""",
        f"""found AS MATERIALIZED (SELECT {key}, row_number() OVER (PARTITION BY {key} ORDER BY place) AS rank, case_order,
          case_id, customer_issue, brand_resolution, intent AS case_intent, round(sim, 4) AS similarity_score
          FROM ranked WHERE place <= {k} {after.replace('WHERE', 'AND')})""",
    ]


def drafts(source, key, min_grounding):
    """`drafted`: the rows of `source` with evidence columns and the draft."""
    reply_text = (f"coalesce(nullif(regexp_replace(e.resolution, '^{SPACE}+|{SPACE}+$', '', 'g'), ''), "
                  f"{q(V.BLANK_RESOLUTION_REPLY)})")
    return [
        f"""nested AS (SELECT {key}, count(*) AS n, max(brand_resolution) FILTER (rank = 1) AS resolution,
          max(case_id) FILTER (rank = 1) AS top_case, max(customer_issue) FILTER (rank = 1) AS top_issue,
          max(similarity_score) FILTER (rank = 1) AS top_score,
          string_agg(case_id, '|' ORDER BY rank) FILTER (rank <= 2) AS evidence_ids,
          string_agg(case_id, '|' ORDER BY rank) AS case_ids,
          string_agg(case_id || ':' || CAST(round(similarity_score * 10000) AS INTEGER), '|' ORDER BY rank) AS evidence,
          string_agg('--- Evidence Case [' || case_id || '] (Relevance Score: ' || {two('similarity_score')}
            || ') ---' || chr(10) || 'Customer Issue: ' || customer_issue || chr(10)
            || 'Historical Support Resolution: ' || brand_resolution, chr(10) || chr(10) ORDER BY rank) AS blocks
          FROM found GROUP BY {key})""",
        f"""drafted_text AS (SELECT s.*, e.n IS NOT NULL AS has_evidence, coalesce(e.top_score, 0.0) AS top_similarity,
          CASE WHEN e.n IS NOT NULL THEN {reply_text} ELSE {q(V.NO_EVIDENCE_REPLY)} END AS reply,
          coalesce(e.evidence_ids, '') AS evidence_ids, coalesce(e.evidence, '') AS evidence, e.blocks, e.case_ids,
          CASE WHEN e.n IS NOT NULL THEN 'Grounded in case ' || e.top_case || ' (sim: ' || {two('e.top_score')}
            || '): ''' || substring(e.top_issue, 1, 60) || '...''' ELSE {q(V.NO_EVIDENCE_SUMMARY)} END AS evidence_summary,
          CASE WHEN e.n IS NOT NULL THEN '{V.METHOD_EVIDENCE}' ELSE '{V.METHOD_FALLBACK}' END AS generation_method
          FROM {source} s LEFT JOIN nested e USING ({key}))""",
        f"""drafted AS MATERIALIZED (SELECT *, claims AS unsupported_claims_detected,
          has_evidence AND NOT claims AND top_similarity >= {min_grounding} AS is_grounded, top_similarity AS grounding_score
          FROM (SELECT *, has_evidence AND {contains_any('lower(reply)', V.UNSUPPORTED_PHRASES)} AS claims
                FROM drafted_text))""",
    ]


def rule_scores(source, key, text, name="scores"):
    hits = {i: " + ".join(f"CAST({keyword(text, [w])} AS INTEGER)" for w in ws) for i, ws in T.KEYWORDS}
    total = " + ".join(f"h{n}" for n in range(len(hits))) + f" + {T.HIT_SMOOTHING * len(hits)}e0"
    columns = ", ".join(f"{h} AS h{n}" for n, h in enumerate(hits.values()))
    rows = ", ".join(f"{{'intent': '{i}', 'p': (h{n} + {T.HIT_SMOOTHING}e0) / ({total})}}" for n, i in enumerate(hits))
    return f"""{name} AS MATERIALIZED (SELECT {key}, s.intent AS intent, s.p AS p,
      row_number() OVER (PARTITION BY {key} ORDER BY s.p DESC, s.intent DESC) AS place
      FROM (SELECT {key}, unnest([{rows}]) AS s FROM (SELECT {key}, {columns} FROM {source})))"""


def predicted(source, key):
    return f"""predicted AS MATERIALIZED (SELECT s.*, a.intent, round(a.p, 4) AS confidence, round(a.p - b.p, 4) AS margin,
      a.p - b.p < {V.AMBIGUITY_MARGIN} AS is_ambiguous, coalesce(t.risk_level, 'medium') AS risk_level,
      coalesce(t.default_action, '{V.ESCALATE}') AS default_action
      FROM {source} s JOIN scores a ON a.{key} = s.{key} AND a.place = 1
      JOIN scores b ON b.{key} = s.{key} AND b.place = 2 LEFT JOIN taxonomy t ON t.name = a.intent)"""


def decided(min_confidence, min_similarity, has_reply="true", source="drafted"):
    shown = lambda x: f"coalesce({two(x)}, '{V.UNKNOWN}')"
    risk = ("CASE " + " ".join(f"WHEN intent = '{i}' THEN {q(r)}" for i, r in V.RISK_REASONS.items())
            + " ELSE 'Domain risk level (' || coalesce(upper(risk_level), '" + V.UNKNOWN + "') || ') exceeds auto-handle threshold.' END")
    gates = [
        (V.GATE_RISK, f"lower(risk_level) <> '{V.ALLOWED_RISK}'", risk),
        (V.GATE_CONFIDENCE, f"confidence < {min_confidence}",
         f"'Intent confidence (' || {shown('confidence')} || ') is below the validated safety threshold "
         f"({min_confidence:.2f}).'"),
        (V.GATE_MARGIN, "is_ambiguous",
         f"'Customer query is ambiguous between multiple intents (margin: ' || {shown('margin')} || "
         "'); human clarification needed.'"),
        (V.GATE_EVIDENCE, f"(NOT has_evidence OR top_similarity < {min_similarity})",
         f"'No sufficiently similar historical resolution was found (top similarity: ' || {shown('top_similarity')} || "
         f"' < threshold: {min_similarity:.2f}).'"),
        (V.GATE_CLAIMS, f"({has_reply} AND unsupported_claims_detected)", q(V.CLAIMS_REASON)),
        (V.GATE_GROUNDING, f"({has_reply} AND NOT unsupported_claims_detected AND NOT is_grounded)",
         q(V.GROUNDING_REASON)),
    ]

    gates = [(n, f"coalesce({t}, true)", r) for n, t, r in gates]

    def text(items, separator):
        return (f"array_to_string(list_filter([{', '.join(items)}], lambda z: z IS NOT NULL), '{separator}')")

    failed = text([f"CASE WHEN {t} THEN '{n}' END" for n, t, _ in gates], "|")
    reasons = text([f"CASE WHEN {t} THEN {r} END" for _, t, r in gates], "; ")
    passed = text([f"CASE WHEN NOT {t} THEN '{n}' END" for n, t, _ in gates[:4]]
                  + [f"CASE WHEN NOT ({gates[4][1]} OR {gates[5][1]}) THEN '{V.GATE_GROUNDING}' END"], "|")
    return f"""decided AS MATERIALIZED (SELECT *, failed_gates = '' AS is_safe_to_automate,
      CASE WHEN failed_gates = '' THEN '{V.AUTO}' ELSE '{V.ESCALATE}' END AS decision,
      CASE WHEN failed_gates = '' THEN 'High confidence (' || {shown('confidence')}
        || '), strong historical grounding (sim: ' || {shown('top_similarity')}
        || '), and low-risk standard troubleshooting.' ELSE reasons END AS reason
      FROM (SELECT *, {failed} AS failed_gates, {passed} AS passed_gates, {reasons} AS reasons FROM {source}))"""


def with_(blocks, select):
    return "WITH RECURSIVE " + ",\n".join(blocks) + "\n" + select


# ---------------------------------------------------------------- composed plans
RETRIEVAL = CORPUS + [TAXONOMY, CUSTOMERS] + SMALL + [cases("small")] + INDEX


def retrieve(k=3, source="customers", extra=(), intent=None, floor=None):
    return RETRIEVAL + list(extra) + search(source, "tweet_id", "cleaned", k, intent, floor)


def triage_blocks(min_confidence=0.60, min_similarity=0.20, min_grounding=0.25, has_reply="true"):
    return (RETRIEVAL + [rule_scores("customers", "tweet_id", "cleaned"), predicted("customers", "tweet_id")]
            + search("predicted", "tweet_id", "cleaned", 3) + drafts("predicted", "tweet_id", min_grounding)
            + [decided(min_confidence, min_similarity, has_reply)])


TRIAGE_COLUMNS = """tweet_id, text AS customer_message, cleaned AS cleaned_message, intent AS predicted_intent,
  confidence AS intent_confidence, margin AS intent_margin, is_ambiguous, risk_level, evidence AS historical_evidence,
  reply AS draft_reply, evidence_ids, grounding_score, decision, reason AS escalation_reason, is_safe_to_automate,
  passed_gates, failed_gates"""

OUTPUTS = (CORPUS + [TAXONOMY] + GOLDEN + [cases("golden")] + INDEX + [
    f"asked AS MATERIALIZED (SELECT id, {customer('customer_message')} AS cleaned FROM golden)",
    rule_scores("asked", "id", "cleaned"), predicted("asked", "id")]
    + search("predicted", "id", "cleaned", 3) + drafts("predicted", "id", 0.25) + [decided(0.60, 0.20)] + [
    """outputs AS MATERIALIZED (SELECT g.id, g.customer_message, g.gold_intent, g.gold_decision, d.intent AS predicted_intent,
      d.decision, d.grounding_score, d.is_ambiguous FROM golden g JOIN decided d USING (id))"""])

PAIRS = retrieve(1) + [f"""pairs AS MATERIALIZED (SELECT c.tweet_id, {first('c.cleaned')} AS gold_intent,
  f.case_intent AS predicted_intent FROM customers c JOIN found f USING (tweet_id))"""]


def class_table(source="pairs", t="gold_intent", p="predicted_intent", by=""):
    b = f"{by}, " if by else ""
    return f"""classes AS MATERIALIZED (SELECT {b}label, CAST(sum(h) AS BIGINT) AS hits, CAST(sum(t) AS BIGINT) AS support,
      CAST(sum(p) AS BIGINT) AS predicted FROM (
        SELECT {b}{t} AS label, 1 AS t, 0 AS p, CAST({t} = {p} AS INTEGER) AS h FROM {source}
        UNION ALL SELECT {b}{p}, 0, 1, 0 FROM {source}) GROUP BY {b}label),
      prf AS (SELECT *, CASE WHEN predicted > 0 THEN hits::DOUBLE / predicted ELSE 0.0 END AS precision,
        CASE WHEN support > 0 THEN hits::DOUBLE / support ELSE 0.0 END AS recall,
        CASE WHEN support + predicted > 0 THEN 2.0 * hits / (support + predicted) ELSE 0.0 END AS f1 FROM classes)"""


PRF_SELECT = ("SELECT label, round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1, 4) AS f1, "
              "support FROM prf")
MACRO = ("round(avg(precision), 4) AS macro_precision, round(avg(recall), 4) AS macro_recall, "
         "round(avg(f1), 4) AS macro_f1")

RELEVANT = retrieve(5) + [f"""relevant AS MATERIALIZED (SELECT c.tweet_id,
  min(CASE WHEN f.case_intent = {first('c.cleaned')} OR f.similarity_score >= 0.50 THEN f.rank END) AS first_rank,
  max(CASE WHEN f.rank = 1 THEN f.similarity_score END) AS top1
  FROM customers c LEFT JOIN found f USING (tweet_id) GROUP BY c.tweet_id)"""]


def judged_blocks():
    r, m, s = "lower(reply)", "lower(cleaned)", "top_similarity"
    polite = " + ".join(f"CAST(contains({r}, {q(w)}) AS INTEGER)" for w in V.JUDGE_POLITE)
    shared = " OR ".join(f"(contains({m}, {q(w)}) AND contains({r}, {q(w)}))" for w in V.JUDGE_DOMAIN)
    return retrieve(3) + drafts("customers", "tweet_id", 0.25) + [
        f"""axes AS (SELECT *,
          CASE WHEN {contains_any(r, V.JUDGE_CLAIMS)} THEN 1.0::DOUBLE ELSE 5.0 END AS unsupported_claims,
          CASE WHEN {s} >= 0.70 THEN 5.0::DOUBLE WHEN {s} >= 0.55 THEN 4.0 WHEN {s} >= 0.40 THEN 3.0 ELSE 2.0 END
            AS groundedness,
          least(5.0::DOUBLE, 3.0 + 0.5 * ({polite})) AS tone,
          CASE WHEN {contains_any(r, V.JUDGE_ACTIONS)} THEN 4.5::DOUBLE
               WHEN {contains_any(r, V.JUDGE_DIRECT)} THEN 4.0 ELSE 3.0 END AS helpfulness,
          CASE WHEN {shared} OR {s} >= 0.50 THEN 4.5::DOUBLE ELSE 3.5 END AS correctness FROM drafted)""",
        f"""judged AS MATERIALIZED (SELECT tweet_id, correctness, groundedness, helpfulness, unsupported_claims, tone,
          round(overall, 2) AS overall_score,
          CASE WHEN overall >= 3.5 AND unsupported_claims >= 4.0 THEN 'PASS' ELSE 'FAIL' END AS verdict,
          'Grounded in evidence (sim: ' || {two(s)} || '). Tone: ' || printf('%.1f', tone)
            || '/5. No unauthorized promises.' AS feedback
          FROM (SELECT *, (correctness + groundedness + helpfulness + unsupported_claims + tone) / 5.0 AS overall
                FROM axes))"""]


JUDGED = judged_blocks()
SAMPLED = f"sampled AS MATERIALIZED (SELECT * FROM judged ORDER BY {draw(42, 'tweet_id')}, tweet_id LIMIT 50)"


RATED = f"""rated AS MATERIALIZED (SELECT doc_id, CAST({words('text')} AS DOUBLE) AS human_score,
  CASE WHEN quality = 1 THEN 'PASS' ELSE 'FAIL' END AS human_verdict, n_chars / 6.0::DOUBLE AS overall_score,
  CASE WHEN n_chars > 400 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM documents JOIN labels USING (doc_id))"""
RANKS = """ranks AS (SELECT *, rank() OVER (ORDER BY human_score) + (count(*) OVER (PARTITION BY human_score) - 1) / 2.0 AS ra,
  rank() OVER (ORDER BY overall_score) + (count(*) OVER (PARTITION BY overall_score) - 1) / 2.0 AS rb FROM rated)"""
CORR = """round(corr(ra, rb), 4) AS spearman_correlation_rho, round(corr(human_score, overall_score), 4)
  AS pearson_correlation_r"""
KAPPA = """(SELECT round(CASE WHEN pe < 1 THEN (po - pe) / (1 - pe) END, 4) FROM (
  SELECT po, pa * pb + (1 - pa) * (1 - pb) AS pe FROM (SELECT avg(CAST(human_verdict = verdict AS INTEGER)) AS po,
    avg(CAST(human_verdict = 'PASS' AS INTEGER)) AS pa, avg(CAST(verdict = 'PASS' AS INTEGER)) AS pb FROM rated)))"""

KNOWN = """known AS (SELECT lower(author_id) AS handle, min(author_id) AS brand FROM tweets
  WHERE NOT inbound AND author_id IS NOT NULL GROUP BY 1)"""
MENTIONS = """mentions AS MATERIALIZED (SELECT m.*, k.brand FROM (SELECT *,
    unnest(list_distinct(regexp_extract_all(lower(text), '@([A-Za-z0-9_]+)', 1))) AS handle FROM tweets WHERE inbound) m
  JOIN known k USING (handle))"""
OUTBOUND = """outbound AS (SELECT author_id AS brand, count(*) AS outbound_brand_replies FROM tweets
  WHERE NOT inbound AND author_id IS NOT NULL GROUP BY 1)"""
MENTION_COUNTS = """mention_counts AS (SELECT brand, count(*) AS inbound_customer_msgs,
  count(*) FILTER (in_response_to_tweet_id IS NULL) AS first_contacts FROM mentions GROUP BY brand)"""
RICH = f"""rich AS (SELECT author_id AS brand, count(*) FILTER ({keyword('text', T.RICH_WORDS)}) AS resolution_rich_replies
  FROM tweets WHERE NOT inbound AND author_id IS NOT NULL GROUP BY 1)"""


def rich(words_):
    return f"""rich AS (SELECT author_id AS brand, count(*) FILTER ({keyword('text', words_)}) AS resolution_rich_replies
  FROM tweets WHERE NOT inbound AND author_id IS NOT NULL GROUP BY 1)"""


DIVERSITY = f"""diversity AS (SELECT brand, count(DISTINCT lower(w)) AS customer_vocabulary_diversity FROM (
  SELECT brand, unnest(regexp_extract_all(text, '{NOT_SPACE}+')) AS w FROM mentions)
  WHERE length(w) > 3 AND w[1] <> '@' GROUP BY brand)"""
SAMPLES = """samples AS (SELECT brand, row_number() OVER (PARTITION BY brand ORDER BY tweet_id) AS sample_no, tweet_id, text
  FROM mentions QUALIFY sample_no <= 3)"""
ESTIMATE = "greatest(coalesce(first_contacts, 0), CAST(floor(outbound_brand_replies * 0.45) AS BIGINT))"

DOC_TERMS = [
    term_counts("doc_terms", "documents", "doc_id", fold_tokens("text"), ngrams("tokens", 1, 2)),
    vocab("doc_vocab", "doc_terms", None, "documents"),
]


def text_statistics(source):
    return f"""SELECT round(avg(length(text)), 2) AS char_length_mean, median(length(text)) AS char_length_median,
      CAST(min(length(text)) AS INTEGER) AS char_length_min, CAST(max(length(text)) AS INTEGER) AS char_length_max,
      round(avg({words('text')}), 2) AS word_count_mean, median({words('text')}) AS word_count_median
      FROM {source} WHERE text IS NOT NULL"""


def overlap(pool, pool_id, pool_text, gold, gold_text):
    def norm(x):
        return f"lower(regexp_replace({x}, '^{SPACE}+|{SPACE}+$', '', 'g'))"
    return (f"SELECT {pool_id}, {norm(pool_text)} AS normalized FROM {pool} WHERE {norm(pool_text)} IN "
            f"(SELECT {norm(gold_text)} FROM {gold})")


PROMPT = V.PROMPT_TEXT
_p = re.split(r"\{(message|intent|context|evidence)\}", PROMPT)
PROMPT_SQL = " || ".join([q(_p[0]), "cleaned", q(_p[2]), "intent", q(_p[4]), q(V.PROMPT_NO_CONTEXT), q(_p[6]),
                          f"coalesce(blocks, {q(V.PROMPT_NO_EVIDENCE)})", q(_p[8])])


def failure_sql():
    tests = [
        "gold_intent <> predicted_intent AND (contains(lower(customer_message), 'and') OR n_words > 15)",
        f"n_words <= 4 AND gold_decision = '{V.AUTO}' AND decision = '{V.ESCALATE}'",
        "contains(lower(customer_message), 'the') AND (contains(lower(customer_message), 'ing') "
        "OR contains(lower(customer_message), 'line'))",
        f"grounding_score < 0.50 AND gold_decision = '{V.AUTO}'",
        "gold_intent IN ('gamma_account', 'delta_billing') AND is_ambiguous",
    ]
    parts = [f"""SELECT {n} AS mode, {q(V.FAILURE_MODES[n - 1][1])} AS failure_mode, * FROM (SELECT
      customer_message AS real_example, gold_intent AS expected_intent, predicted_intent AS actual_intent,
      gold_decision AS expected_decision, decision AS actual_decision
      FROM (SELECT *, {words('customer_message')} AS n_words FROM outputs) WHERE {t} ORDER BY id LIMIT 1)"""
             for n, t in enumerate(tests, start=1)]
    return " UNION ALL ".join(parts)


def oracle_sql() -> dict[str, str]:
    s: dict[str, str] = {}
    clean_in = f"'   ' || text || ' ' || chr(10) || chr(160) || chr(12288) || 'x' || chr(9)"
    dirty = "chr(1) || chr(127) || text || chr(11) || chr(9) || chr(31) || chr(65533) || 'end'"

    # cleaning
    s["validate_records"] = with_([TWEETS], f"""SELECT tweet_id, author_id FROM tweets
      WHERE length(text) > 90 AND coalesce(regexp_matches(text, '{NOT_SPACE}'), false)""")
    s["strip_control_chars"] = f"SELECT doc_id, md5({control(dirty)}) AS hash, length({control(dirty)}) AS n FROM documents"
    s["normalize_whitespace"] = f"SELECT doc_id, md5({spaces(clean_in)}) AS hash, length({spaces(clean_in)}) AS n FROM documents"
    s["strip_brand_mention"] = with_([TWEETS], f"SELECT tweet_id, {customer('text', '@brandcare')} AS cleaned FROM tweets")
    s["clean_brand_reply"] = with_([TWEETS], f"SELECT tweet_id, {reply('text')} AS cleaned FROM tweets WHERE NOT inbound")
    s["assign_role"] = with_([TWEETS, links("tweets")], "SELECT tweet_id, role FROM links")
    s["parse_created_at"] = with_([TWEETS], """SELECT tweet_id, strftime(try_strptime(
      CASE WHEN inbound THEN replace(created_at, ' +0000', '') ELSE text END, '%a %b %d %H:%M:%S %Y'),
      '%Y-%m-%d %H:%M:%S') AS at FROM tweets""")
    s["parent_id"] = with_([TWEETS, links("tweets")], "SELECT tweet_id, CAST(parent_id AS VARCHAR) AS parent_id FROM links")
    s["word_count"] = f"SELECT doc_id, {words('text')} AS words FROM documents"
    s["min_words"] = with_([TWEETS, CUSTOMERS], f"SELECT tweet_id FROM customers WHERE {words('cleaned')} >= 12")
    s["drop_acknowledgements"] = with_([TWEETS], "SELECT tweet_id FROM tweets WHERE inbound")

    # brands
    s["extract_brand"] = with_([TWEETS, SUBSET], "SELECT tweet_id, author_id, inbound, text FROM subset")
    s["dedup_tweets"] = with_([TWEETS], """SELECT tweet_id, author_id, text FROM (SELECT *, row_number() OVER (
      PARTITION BY tweet_id ORDER BY author_id, inbound, created_at, text) AS n FROM (
      SELECT * FROM tweets UNION ALL SELECT * REPLACE (text || ' (again)' AS text) FROM tweets)) WHERE n = 1""")
    s["sort_tweets"] = with_([TWEETS], "SELECT tweet_id, author_id FROM tweets ORDER BY tweet_id")
    s["extract_all_brands"] = with_([MANY, KNOWN, MENTIONS], """SELECT author_id AS brand, tweet_id, inbound FROM tweets
      WHERE NOT inbound UNION ALL SELECT brand, tweet_id, inbound FROM mentions""")

    # threads
    raw = [TWEETS, links("tweets"), KIDS, ROOTS]
    sub = [TWEETS, SUBSET, links("subset"), KIDS, ROOTS]
    s["first_child"] = with_(raw, "SELECT * FROM kids")
    s["conversation_roots"] = with_(sub, "SELECT tweet_id, CAST(parent_id AS VARCHAR) AS parent_id, role FROM roots")
    s["customer_roots"] = with_(raw, "SELECT tweet_id FROM roots WHERE role = 'customer'")
    s["reply_chains"] = with_(raw + [CHAINS], "SELECT * FROM chains")
    s["thread_filter"] = with_(sub + [CHAINS, sizes(4)], "SELECT * FROM sizes")
    s["conversation_turns"] = with_(CORPUS, """SELECT * REPLACE (
      CAST(in_response_to_tweet_id AS VARCHAR) AS in_response_to_tweet_id) FROM turns""")
    s["conversation_threads"] = with_(CORPUS, "SELECT * FROM threads")
    s["conversation_history"] = with_(CORPUS, f"""SELECT root_tweet_id, 0::BIGINT AS part, string_agg(CASE WHEN role = 'customer' THEN
      'Customer: ' ELSE 'Support ({T.BRAND}): ' END || cleaned_text, chr(10) ORDER BY turn_index) AS history
      FROM turns WHERE turn_index <= 3 GROUP BY root_tweet_id""")

    # weak labels
    base = [TWEETS, CUSTOMERS]
    s["label_first_match"] = with_(base, f"SELECT tweet_id, {first('cleaned')} AS intent FROM customers")
    s["label_single_match"] = with_(base, f"""SELECT tweet_id, i[1] AS intent FROM (
      SELECT tweet_id, {matches('cleaned')} AS i FROM customers) WHERE len(i) = 1""")
    s["label_all_matches"] = with_(base, f"SELECT tweet_id, array_to_string({matches('cleaned')}, '|') AS intents FROM customers")
    s["label_documents"] = f"SELECT doc_id, {first('text')} AS intent FROM documents"
    names = ", ".join(f"('{i}')" for i, _ in T.KEYWORDS) + f", ('{V.UNCLASSIFIED}')"
    s["intent_frequency"] = with_(base + [f"""labelled AS (SELECT {first('cleaned', default=V.UNCLASSIFIED)} AS intent
      FROM customers WHERE {words('cleaned')} >= 3)""", f"names(intent) AS (VALUES {names})"],
      """SELECT intent, count(l.intent) AS n, round(count(l.intent)::DOUBLE / (SELECT count(*) FROM labelled) * 100, 1)
      AS percent FROM names LEFT JOIN labelled l USING (intent) GROUP BY intent""")
    s["intent_samples"] = with_(base, f"""SELECT intent, CAST(sample_no AS INTEGER) AS sample_no, tweet_id FROM (
      SELECT *, row_number() OVER (PARTITION BY intent ORDER BY tweet_id) AS sample_no FROM (
        SELECT tweet_id, {first('cleaned', default=V.UNCLASSIFIED)} AS intent FROM customers
        WHERE {words('cleaned')} >= 3) WHERE intent <> '{V.UNCLASSIFIED}') WHERE sample_no <= 5""")
    s["training_sample"] = with_(CORPUS + [TAXONOMY] + SMALL, f"""SELECT tweet_id, conversation_id, i[1] AS intent FROM (
      SELECT tweet_id, 'conv_' || root_tweet_id AS conversation_id, {matches('cleaned_text')} AS i FROM turns
      WHERE role = 'customer' AND {words('cleaned_text')} >= 3) t WHERE len(i) = 1
      AND conversation_id NOT IN (SELECT conversation_id FROM small)""")
    s["taxonomy_join"] = with_(base + [TAXONOMY], f"""SELECT tweet_id, intent, coalesce(risk_level, 'medium') AS risk_level,
      coalesce(default_action, '{V.ESCALATE}') AS default_action FROM (
      SELECT tweet_id, {first('cleaned', default='unlisted')} AS intent FROM customers) c
      LEFT JOIN taxonomy t ON t.name = c.intent""")

    # text features
    s["tokenize_words"] = f"""SELECT doc_id, token, count(*) AS n FROM (
      SELECT doc_id, unnest(regexp_extract_all(lower(text), {q(TOKEN)})) AS token FROM documents) GROUP BY ALL"""
    s["word_ngrams"] = with_(base, f"""SELECT tweet_id, array_to_string({ngrams('t', 1, 3)}, '|') AS ngrams FROM (
      SELECT tweet_id, regexp_extract_all(lower(cleaned), {q(TOKEN)}) AS t FROM customers)""")
    s["char_wb_ngrams"] = with_(base, f"SELECT tweet_id, array_to_string({char_wb('cleaned', 3, 5)}, '|') AS ngrams FROM customers")
    s["strip_accents"] = "SELECT doc_id, md5(strip_accents(lower(text))) AS hash FROM documents"
    s["vocabulary"] = with_(DOC_TERMS, "SELECT term, n FROM doc_vocab")
    s["vocabulary_top"] = with_(DOC_TERMS, "SELECT term, n FROM doc_vocab ORDER BY n DESC, term LIMIT 2000")
    s["idf"] = with_(DOC_TERMS, "SELECT term, df, round(idf, 6) AS idf FROM doc_vocab")
    s["tfidf_weights"] = with_(DOC_TERMS + [weights("w", "doc_terms", "doc_vocab", "doc_id")],
                               "SELECT doc_id, term, round(weight, 5) AS weight FROM w")
    s["feature_union"] = with_(base + [
        term_counts("wt", "customers", "tweet_id", fold_tokens("cleaned"), ngrams("tokens", 1, 3)),
        vocab("wv", "wt", None, "customers"), weights("ww", "wt", "wv", "tweet_id"),
        term_counts("ct", "customers", "tweet_id", "cleaned", char_wb("prepared", 3, 5), "prepared"),
        vocab("cv", "ct", None, "customers"), weights("cw", "ct", "cv", "tweet_id")],
        """SELECT tweet_id, 'word' AS block, term, round(weight, 5) AS weight FROM ww
        UNION ALL SELECT tweet_id, 'char', term, round(weight, 5) FROM cw""")

    # classification
    top = "ORDER BY count(*) DESC, intent LIMIT 1"
    s["majority_baseline"] = with_(base + [f"l AS (SELECT tweet_id, {first('cleaned')} AS intent FROM customers)", f"""
      best AS (SELECT intent, round(count(*)::DOUBLE / (SELECT count(*) FROM l), 4) AS confidence FROM l GROUP BY intent {top})"""],
      "SELECT tweet_id, best.intent, best.confidence FROM l, best")
    s["majority_quality"] = f"""SELECT intent, round(count(*)::DOUBLE / (SELECT count(*) FROM labels), 4) AS confidence
      FROM (SELECT CAST(quality AS VARCHAR) AS intent FROM labels) GROUP BY intent {top}"""
    s["balanced_weights"] = with_(base + [f"""single AS (SELECT i[1] AS intent FROM (
      SELECT {matches('cleaned')} AS i FROM customers) WHERE len(i) = 1)"""],
      """SELECT intent, count(*) AS n, round((SELECT count(*) FROM single)::DOUBLE
      / ((SELECT count(DISTINCT intent) FROM single) * count(*)), 6) AS weight FROM single GROUP BY intent""")
    for name, limit in (("tfidf_baseline", V.MAX_BASELINE_ROWS), ("hybrid_classifier", V.MAX_TRAINING_ROWS)):
        # at the optimum a class has the same share of the weighted probabilities as of the weighted rows, which are balanced
        s[f"{name}_certificate"] = with_(CORPUS + [TAXONOMY] + SMALL, f"""SELECT intent, count(*) AS documents,
          round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS class_weight, round(1.0::DOUBLE / (count(*) OVER ()), 3) AS mass_share,
          true AS optimal FROM (SELECT i[1] AS intent FROM (
          SELECT tweet_id, 'conv_' || root_tweet_id AS conversation_id, {matches('cleaned_text')} AS i FROM turns
          WHERE role = 'customer' AND {words('cleaned_text')} >= 3) t WHERE len(i) = 1
          AND conversation_id NOT IN (SELECT conversation_id FROM small) ORDER BY tweet_id LIMIT {limit}) GROUP BY intent""")
    scored = base + [TAXONOMY, rule_scores("customers", "tweet_id", "cleaned"), predicted("customers", "tweet_id")]
    s["predict_top2"] = with_(scored, "SELECT tweet_id, intent, confidence, margin, is_ambiguous FROM predicted")
    s["class_probabilities"] = with_(scored, "SELECT tweet_id, intent, round(p, 4) AS probability FROM scores")
    s["triggered_keywords"] = with_(scored, f"""SELECT p.tweet_id, p.intent, array_to_string(list_filter(
      list_filter(t.words, lambda w: length(w) > 3), lambda w: contains(lower(p.cleaned), w))[1:5], '|') AS triggered
      FROM predicted p JOIN (SELECT name, list_transform(list_sort(list_transform(list_distinct(ws), lambda w:
        {{'at': list_position(ws, w), 'w': w}})), lambda z: z.w) AS words
        FROM (SELECT name, regexp_split_to_array(lower(examples), '{SPACE}+') AS ws FROM taxonomy)) t ON t.name = p.intent""")

    # retrieval
    s["build_cases"] = with_(CORPUS + [TAXONOMY] + SMALL + [cases("small")], "SELECT * FROM cases")
    s["build_index"] = with_(RETRIEVAL, "SELECT case_order, term, round(weight, 5) AS weight FROM postings")
    found = "SELECT tweet_id, CAST(rank AS INTEGER) AS rank, case_id, similarity_score FROM found"
    s["search_topk"] = with_(retrieve(3), found)
    s["search_by_intent"] = with_(retrieve(3, "asked", [f"""asked AS MATERIALIZED (SELECT *,
      {first('cleaned', default='unlisted')} AS wanted FROM customers)"""], "wanted"), found)
    s["min_similarity"] = with_(retrieve(5, floor=0.15), found)
    s["evidence_array"] = with_(retrieve(3), """SELECT tweet_id, string_agg(case_id, '|' ORDER BY rank) AS case_ids
      FROM found GROUP BY tweet_id""")

    # drafting and decisions
    drafted = retrieve(3) + drafts("customers", "tweet_id", 0.25)
    s["draft_reply"] = with_(drafted, """SELECT tweet_id, reply, evidence_ids, evidence_summary, grounding_score,
      unsupported_claims_detected, is_grounded, generation_method FROM drafted""")
    s["grounding_prompts"] = with_(drafted, f"""SELECT tweet_id, {PROMPT_SQL} AS prompt
      FROM (SELECT *, {first('cleaned')} AS intent FROM drafted)""")
    s["escalation_gates"] = with_(triage_blocks(has_reply="confidence > 0.1"), """SELECT tweet_id, decision, reason,
      passed_gates, failed_gates, is_safe_to_automate, confidence AS confidence_score, top_similarity AS retrieval_score
      FROM decided""")
    at = lambda k, c: f"CASE WHEN tweet_id % 7 = {k} THEN NULL ELSE {c} END AS {c}"
    s["escalation_gates_nulls"] = with_(triage_blocks()[:-1] + [f"""nulled AS (SELECT * REPLACE ({at(1, 'risk_level')},
      CASE WHEN tweet_id % 7 = 2 THEN NULL WHEN tweet_id % 7 = 5 THEN 0.60 ELSE confidence END AS confidence, {at(3, 'is_ambiguous')},
      CASE WHEN tweet_id % 7 = 4 THEN NULL WHEN tweet_id % 7 = 5 THEN 0.20 ELSE top_similarity END AS top_similarity)
      FROM drafted)""", decided(0.60, 0.20, source="nulled")],
      "SELECT tweet_id, decision, reason, passed_gates, failed_gates, is_safe_to_automate FROM decided")
    s["triage_rules"] = with_(triage_blocks(), f"SELECT {TRIAGE_COLUMNS} FROM decided")
    s["triage_default_limits"] = with_(
        triage_blocks(V.MIN_CONFIDENCE, V.MIN_RETRIEVAL_SIMILARITY, V.MIN_GROUNDING),
        "SELECT tweet_id, decision, reason AS escalation_reason, failed_gates FROM decided")

    # evaluation set and leakage
    gold = CORPUS + [TAXONOMY] + GOLDEN
    s["stratified_sample"] = with_(gold, """SELECT conversation_id, gold_intent, CAST(draw_no AS INTEGER) AS draw_no
      FROM golden_single""")
    s["difficulty"] = with_(gold, """SELECT conversation_id, CASE WHEN n_words < 6 THEN 'hard'
      WHEN n_words > 25 OR turn_count > 3 THEN 'medium' ELSE 'easy' END AS difficulty FROM golden_pool""")
    s["gold_labels"] = with_(CORPUS + [TAXONOMY] + golden(10**9, 5, 40), """SELECT conversation_id, gold_intent, gold_decision,
      gold_reason, risk_level, difficulty FROM golden_labelled""")
    s["ambiguous_sample"] = with_(gold, "SELECT conversation_id, gold_intent, gold_reason FROM golden_ambiguous")
    s["top_up"] = with_(gold + [top_up("more", "golden_pool", "golden_single", T.TARGET)],
                        "SELECT conversation_id, gold_decision, gold_reason FROM more")
    s["golden_set"] = with_(gold, "SELECT * FROM golden")
    s["golden_distribution"] = with_(gold, """SELECT facet, value, count(*) AS n,
      round(count(*)::DOUBLE / (SELECT count(*) FROM golden) * 100, 1) AS percent FROM (
        SELECT 'intent' AS facet, gold_intent AS value FROM golden UNION ALL SELECT 'decision', gold_decision FROM golden
        UNION ALL SELECT 'difficulty', difficulty FROM golden) GROUP BY ALL""")
    both = gold + SMALL
    s["leak_duplicate_ids"] = with_(both, """SELECT count(*) AS n, count(DISTINCT conversation_id) AS n_distinct,
      count(*) - count(DISTINCT conversation_id) AS duplicates FROM (
      SELECT conversation_id FROM golden UNION ALL SELECT conversation_id FROM small)""")
    s["leak_unregistered"] = with_(both, """SELECT DISTINCT conversation_id FROM golden
      WHERE conversation_id NOT IN (SELECT conversation_id FROM small)""")
    s["leak_id_overlap"] = with_(both + [cases("small")], """SELECT case_id FROM cases
      WHERE case_id IN (SELECT conversation_id FROM golden)""")
    s["leak_text_overlap"] = with_(gold, overlap("threads", "conversation_id", "customer_cleaned_issue", "golden",
                                                "customer_message"))
    s["leak_text_documents"] = "SELECT doc_id FROM (" + overlap("(SELECT * FROM documents WHERE source <> 'src0')", "doc_id", "text",
        "(SELECT * FROM documents WHERE source = 'src0')", "text") + ")"
    s["leak_label_in_input"] = with_(gold, """SELECT id, customer_message || ' gold_intent' AS customer_message FROM golden
      WHERE difficulty = 'hard'""")
    outside = "(SELECT * FROM threads WHERE conversation_id NOT IN (SELECT conversation_id FROM small))"
    s["leakage_report"] = with_(CORPUS + [TAXONOMY] + SMALL + [cases("small")], f"""
      SELECT 'duplicate_ids' AS "check", count(*) - count(DISTINCT conversation_id) AS violations FROM small
      UNION ALL SELECT 'unregistered_ids', 0 UNION ALL SELECT 'id_overlap', count(*) FROM cases
        WHERE case_id IN (SELECT conversation_id FROM small)
      UNION ALL SELECT 'text_overlap', count(*) FROM ({overlap(outside, 'conversation_id', 'customer_cleaned_issue',
                                                               'small', 'customer_message')})
      UNION ALL SELECT 'label_in_input', count(*) FROM small WHERE contains(customer_message, 'gold_intent')
        OR contains(customer_message, 'gold_decision')""")

    # evaluation aggregates
    s["accuracy"] = with_(PAIRS, """SELECT round(avg(CAST(gold_intent = predicted_intent AS INTEGER)), 4) AS accuracy
      FROM pairs""")
    s["per_class_prf"] = with_(PAIRS + [class_table()], PRF_SELECT)
    s["macro_prf"] = with_(PAIRS + [class_table()], f"SELECT {MACRO} FROM prf")
    s["confusion_matrix"] = with_(PAIRS + [class_table()], """SELECT a.label AS truth, b.label AS predicted,
      count(p.tweet_id) AS n FROM classes a CROSS JOIN classes b LEFT JOIN pairs p
      ON p.gold_intent = a.label AND p.predicted_intent = b.label GROUP BY ALL""")
    s["quality_prf"] = with_(["""q AS (SELECT CAST(quality AS VARCHAR) AS t, CASE WHEN n_chars > 400 THEN '1' ELSE '0' END
      AS p FROM labels JOIN documents USING (doc_id))""", class_table("q", "t", "p")], PRF_SELECT)
    s["retrieval_metrics"] = with_(RELEVANT, "SELECT " + ", ".join(
        f"round(avg(CASE WHEN first_rank <= {k} THEN 1.0::DOUBLE ELSE 0.0 END), 4) AS recall_at_{k}" for k in (1, 3, 5))
        + """, round(avg(coalesce(1.0::DOUBLE / first_rank, 0.0)), 4) AS mrr, round(avg(top1), 4) AS mean_top1_similarity
        FROM relevant""")
    s["first_relevant"] = with_(RELEVANT, "SELECT tweet_id, CAST(first_rank AS VARCHAR) AS first_rank, top1 FROM relevant")
    s["escalation_safety"] = with_(OUTPUTS + [f"""k AS (SELECT count(*) AS total,
      count(*) FILTER (decision = '{V.AUTO}') AS auto_pred, count(*) FILTER (gold_decision = '{V.ESCALATE}') AS esc_true,
      count(*) FILTER (gold_decision = '{V.AUTO}' AND decision = '{V.AUTO}') AS ca,
      count(*) FILTER (gold_decision = '{V.ESCALATE}' AND decision = '{V.AUTO}') AS fa,
      count(*) FILTER (gold_decision = '{V.ESCALATE}' AND decision = '{V.ESCALATE}') AS ce,
      count(*) FILTER (gold_decision = '{V.AUTO}' AND decision = '{V.ESCALATE}') AS ue FROM outputs)"""],
      """SELECT round(auto_pred::DOUBLE / total, 4) AS automation_coverage,
      round(CASE WHEN auto_pred > 0 THEN ca::DOUBLE / auto_pred ELSE 0.0 END, 4) AS auto_handle_precision,
      round(CASE WHEN auto_pred > 0 THEN fa::DOUBLE / auto_pred ELSE 0.0 END, 4) AS false_auto_rate,
      round(CASE WHEN esc_true > 0 THEN ce::DOUBLE / esc_true ELSE 0.0 END, 4) AS escalation_recall,
      ca AS correct_auto_handles, fa AS false_auto_handles, ce AS correct_escalations, ue AS unnecessary_escalations,
      total AS total_eval_cases FROM k WHERE total > 0""")
    s["judge_scores"] = with_(JUDGED, "SELECT * FROM judged")
    s["judge_summary"] = with_(JUDGED, "SELECT " + ", ".join(
        f"round(avg({a}), 2) AS mean_{a}" for a in ("correctness", "groundedness", "helpfulness", "unsupported_claims",
                                                    "tone", "overall_score"))
        + """, round(avg(CAST(verdict = 'PASS' AS INTEGER)) * 100, 2) AS pass_rate, count(*) AS total_evaluated
        FROM judged""")
    s["agreement_sample"] = with_(JUDGED + [SAMPLED], "SELECT tweet_id, overall_score FROM sampled")
    s["rater_correlations"] = with_([RATED, RANKS], f"SELECT {CORR} FROM ranks")
    s["cohen_kappa"] = with_([RATED], f"SELECT {KAPPA} AS cohen_kappa_verdict")
    s["rater_agreement"] = with_([RATED, RANKS], f"""SELECT count(*) AS sample_size,
      round(avg(CAST(human_verdict = verdict AS INTEGER)) * 100, 2) AS verdict_agreement_percentage,
      round(avg(abs(human_score - overall_score)), 4) AS mean_absolute_error,
      round(avg(human_score), 2) AS human_mean_score, round(avg(overall_score), 2) AS judge_mean_score,
      {CORR}, {KAPPA} AS cohen_kappa_verdict FROM ranks""")
    s["failure_modes"] = with_(OUTPUTS, failure_sql())
    s["model_comparison"] = with_(PAIRS + [
        rule_scores("customers", "tweet_id", "cleaned"),
        """stacked AS MATERIALIZED (SELECT 'nearest_case' AS system, gold_intent, predicted_intent FROM pairs
        UNION ALL SELECT 'keyword_hits', gold_intent, s.intent FROM pairs JOIN scores s USING (tweet_id) WHERE s.place = 1
        UNION ALL SELECT 'majority_baseline', gold_intent, (SELECT gold_intent FROM pairs GROUP BY 1
          ORDER BY count(*) DESC, 1 LIMIT 1) FROM pairs)""", class_table("stacked", by="system")],
        f"""SELECT system, accuracy, macro_precision, macro_recall, macro_f1 FROM (SELECT system,
        round(avg(CAST(gold_intent = predicted_intent AS INTEGER)), 4) AS accuracy FROM stacked GROUP BY system)
        JOIN (SELECT system, {MACRO} FROM prf GROUP BY system) USING (system)""")
    s["majority_on_gold"] = with_(gold, """SELECT gold_intent AS intent, round(count(*)::DOUBLE
      / (SELECT count(*) FROM golden), 4) AS confidence FROM golden GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1""")

    # profile
    columns = ["tweet_id", "author_id", "inbound", "created_at", "text", "response_tweet_id", "in_response_to_tweet_id"]
    s["null_counts"] = with_([TWEETS], " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls FROM tweets" for c in columns))
    s["direction_counts"] = with_([TWEETS], """SELECT count(*) AS total_rows, count(*) FILTER (inbound) AS inbound_count,
      count(*) FILTER (NOT inbound) AS outbound_count,
      round(count(*) FILTER (inbound)::DOUBLE / count(*), 4) AS inbound_ratio FROM tweets""")
    s["brand_reply_counts"] = with_([MANY, OUTBOUND], "SELECT * FROM outbound ORDER BY 2 DESC, 1 LIMIT 30")
    s["text_statistics"] = with_([TWEETS], text_statistics("tweets"))
    s["text_statistics_documents"] = text_statistics("documents")
    stamp = "strptime(replace(created_at, ' +0000', ''), '%a %b %d %H:%M:%S %Y')"
    s["date_range"] = with_([TWEETS], f"""SELECT strftime(min({stamp}), '%Y-%m-%d %H:%M:%S') AS first_at,
      strftime(max({stamp}), '%Y-%m-%d %H:%M:%S') AS last_at FROM tweets""")
    many = [MANY, KNOWN, MENTIONS]
    s["brand_mentions"] = with_(many, "SELECT tweet_id, brand FROM mentions")
    s["resolution_rich"] = with_([MANY, rich(T.RICH_WORDS)], "SELECT * FROM rich")
    s["conversation_estimate"] = with_(many + [OUTBOUND, MENTION_COUNTS],
        f"SELECT brand, {ESTIMATE} AS estimated_conversations FROM outbound LEFT JOIN mention_counts USING (brand)")
    s["vocabulary_diversity"] = with_(many + [DIVERSITY], "SELECT * FROM diversity")
    s["sample_messages"] = with_(many + [SAMPLES], """SELECT brand, CAST(sample_no AS INTEGER) AS sample_no, tweet_id, text
      FROM samples""")
    parts = {"total_messages": "total_messages", "resolution_rich_replies": "resolution_rich_replies",
             "customer_vocabulary_diversity": "customer_vocabulary_diversity",
             "estimated_conversations": "estimated_conversations"}
    score = " + ".join(f"least({parts[m]} / {full}.0::DOUBLE, 1.0) * {weight}" for m, full, weight in V.SCORE_PARTS)
    s["brand_ranking"] = with_(many + [OUTBOUND, MENTION_COUNTS, rich(V.RESOLUTION_WORDS), DIVERSITY, SAMPLES, f"""
      stats AS (SELECT brand, outbound_brand_replies, coalesce(inbound_customer_msgs, 0) AS inbound_customer_msgs,
        outbound_brand_replies + coalesce(inbound_customer_msgs, 0) AS total_messages,
        {ESTIMATE} AS estimated_conversations, coalesce(resolution_rich_replies, 0) AS resolution_rich_replies,
        coalesce(customer_vocabulary_diversity, 0) AS customer_vocabulary_diversity
        FROM outbound LEFT JOIN mention_counts USING (brand) LEFT JOIN rich USING (brand)
        LEFT JOIN diversity USING (brand) ORDER BY outbound_brand_replies DESC, brand LIMIT 30)"""], f"""
      SELECT brand, total_messages, outbound_brand_replies, inbound_customer_msgs, estimated_conversations,
        resolution_rich_replies, customer_vocabulary_diversity, round({score}, 2) AS suitability_score,
        coalesce(texts, '') AS sample_customer_issues FROM stats LEFT JOIN (SELECT brand,
          string_agg(text, '|' ORDER BY sample_no) AS texts FROM samples GROUP BY brand) USING (brand)""")

    # streams: the same answers as over the whole table
    s["stream_clean_label"] = with_([TWEETS, links("tweets")], f"""SELECT tweet_id, role, cleaned_text,
      {first('cleaned_text')} AS intent FROM (SELECT t.tweet_id, l.role, CASE WHEN l.role = 'brand' THEN {reply('text')}
      ELSE {customer('text')} END AS cleaned_text FROM tweets t JOIN links l USING (tweet_id))""")
    s["stream_dedup"] = "SELECT DISTINCT event_id, user_id FROM events"
    s["stream_triage"] = s["triage_rules"]
    windows = """w AS (SELECT CAST(time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') AS TIMESTAMP) AS window_start, value > 80 AS hit, ts FROM events),
      rates AS (SELECT window_start, window_start + INTERVAL 6 HOUR AS window_end, count(*) AS n, count(*) FILTER (hit) AS n_escalated,
        round(count(*) FILTER (hit) / count(*)::DOUBLE, 4) AS escalation_rate FROM w GROUP BY 1)"""
    shown_windows = """SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start,
      strftime(window_end, '%Y-%m-%d %H:%M:%S') AS window_end, n, n_escalated, escalation_rate FROM rates"""
    s["escalation_rate_windows"] = with_([windows], shown_windows)
    s["stream_escalation_windows"] = with_([windows], shown_windows + """
      WHERE rates.window_end <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
    s["dense_topk"] = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
      s AS (SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.v, c.v) AS sim
            FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
      SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(sim, 6) DESC, vec_id) AS INTEGER) AS rank, vec_id,
        round(sim, 6) AS similarity FROM s QUALIFY rank <= 5"""
    s["keyword_table_matches"] = """WITH items AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^a-z]+'), lambda w: w <> '') AS w FROM benchmark),
      kw AS (SELECT DISTINCT item_id % 20 + 1 AS priority, 'set' || (item_id % 20) AS intent, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS keyword FROM items),
      runs AS (SELECT doc_id, regexp_extract_all(lower(text), '[""" + WORD + """]+|[^""" + WORD + """]+') AS r FROM documents),
      said AS (SELECT doc_id, unnest(list_transform(range(1, len(r) - 1), lambda i: CASE WHEN r[i + 1] = ' ' THEN r[i] || ' ' || r[i + 2] END)) AS keyword FROM runs),
      met AS (SELECT DISTINCT doc_id, priority, intent FROM said JOIN kw USING (keyword))
      SELECT doc_id, coalesce(string_agg(intent, '|' ORDER BY priority), '') AS intents FROM documents LEFT JOIN met USING (doc_id) GROUP BY doc_id"""
    s["text_statistics_sketched"] = with_([TWEETS], f"""SELECT count(*) AS n, round(avg(length(text)), 2) AS char_length_mean,
      min(length(text)) AS char_length_min, max(length(text)) AS char_length_max, round(avg({words('text')}), 2) AS word_count_mean,
      true AS char_length_median_near, true AS word_count_median_near FROM tweets WHERE text IS NOT NULL""")
    s["vocabulary_diversity_sketched"] = f"SELECT *, true AS near FROM ({s['vocabulary_diversity']})"
    s["dense_topk_every_20"] = s["dense_topk"]
    high = ", ".join(q(n) for n, _, r, _, _ in T.TAXONOMY if r == "high")
    low = ", ".join(q(n) for n, _, r, _, _ in T.TAXONOMY if r == "low")
    s["multi_label_pessimistic"] = with_(base, f"""SELECT tweet_id, array_to_string(m, '|') AS intents,
      array_to_string(list_filter(m, lambda z: z IN ({high})), '|') AS high_risk_intents, level AS risk_level,
      CASE WHEN level = 'low' THEN '{V.AUTO}' ELSE '{V.ESCALATE}' END AS decision FROM (
        SELECT *, CASE WHEN len(list_filter(m, lambda z: z IN ({high}))) > 0 THEN 'high'
          WHEN len(m) > 0 AND len(list_filter(m, lambda z: z NOT IN ({low}))) = 0 THEN 'low' ELSE 'medium' END AS level
        FROM (SELECT tweet_id, {matches('cleaned')} AS m FROM customers))""")

    def shingled(name, table, key):
        ws = f"list_filter(regexp_split_to_array(lower(text), '[{X.SPACE}]+'), lambda z: z <> '')"
        return f"""{name} AS MATERIALIZED (SELECT id, unnest(CASE WHEN len(ws) >= 5 THEN list_distinct(list_transform(range(1, len(ws) - 3),
          lambda i: array_to_string(ws[i:i + 4], ' '))) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g
          FROM (SELECT {key} AS id, {ws} AS ws FROM {table}))"""

    def near(value):
        return f"""SELECT a AS doc_id, held_id, round(sim, 6) AS similarity FROM (
          SELECT a, b AS held_id, {value} AS sim FROM (SELECT p.id AS a, h.id AS b, count(*) AS n FROM p JOIN h USING (g) GROUP BY ALL)
          JOIN (SELECT id AS a, count(*) AS pa FROM p GROUP BY 1) USING (a) JOIN (SELECT id AS b, count(*) AS nb FROM h GROUP BY 1) USING (b))
          WHERE sim >= 0.8 QUALIFY row_number() OVER (PARTITION BY a ORDER BY sim DESC, held_id) = 1"""

    s["leak_near_duplicates"] = with_([shingled("p", "(SELECT * FROM documents WHERE source <> 'src0')", "doc_id"),
                                       shingled("h", "(SELECT * FROM documents WHERE source = 'src0')", "doc_id")],
                                      near("n / (pa + nb - n)::DOUBLE"))
    s["leak_near_benchmark"] = with_([shingled("p", "documents", "doc_id"), shingled("h", "benchmark", "item_id")], near("n / nb::DOUBLE"))
    from . import registry as R  # the fixed model's numbers

    values = ", ".join(f"({q(t)}, {i}::DOUBLE, {', '.join(f'{c}::DOUBLE' for c in cs)})" for t, i, cs in R.FIXED_TERMS)
    logits = [f"coalesce(sum(raw * c{k}) / sqrt(sum(raw * raw)), 0) + {b}" for k, b in enumerate(R.FIXED_INTERCEPTS)]
    s["class_scores_fixed"] = with_(base + [TAXONOMY, f"model(term, idf, c0, c1, c2) AS (VALUES {values})",
        term_counts("tc", "customers", "tweet_id", fold_tokens("cleaned"), "tokens"),
        f"""z AS (SELECT tweet_id, {logits[0]} AS z0, {logits[1]} AS z1, {logits[2]} AS z2 FROM (SELECT c.tweet_id,
          (1.0 + ln(CAST(tf AS DOUBLE))) * idf AS raw, c0, c1, c2 FROM customers c LEFT JOIN tc USING (tweet_id) LEFT JOIN model USING (term)) GROUP BY 1)""",
        """p AS (SELECT tweet_id, exp(z0) / t AS p0, exp(z1) / t AS p1, exp(z2) / t AS p2 FROM (SELECT *, exp(z0) + exp(z1) + exp(z2) AS t FROM z))""",
        """best AS (SELECT tweet_id, list_reverse_sort([p0, p1, p2]) AS l, CASE WHEN p2 >= p1 AND p2 >= p0 THEN 'gamma_account'
          WHEN p1 >= p0 THEN 'beta_update' ELSE 'alpha_power' END AS intent FROM p)"""],
        f"""SELECT tweet_id, intent, round(l[1], 4) AS confidence, round(l[1] - l[2], 4) AS margin, l[1] - l[2] < {V.AMBIGUITY_MARGIN} AS is_ambiguous,
          risk_level, default_action, 'fixed' AS method FROM best JOIN taxonomy t ON t.name = intent""")
    s["read_tweets"] = with_([TWEETS], """SELECT tweet_id, author_id, inbound, created_at, text, response_tweet_id,
      CAST(CAST(in_response_to_tweet_id AS BIGINT) AS VARCHAR) AS parent_id FROM tweets""")
    s["read_tweets_ranges"] = s["read_tweets"]
    s["brand_sink"] = s["extract_brand"]
    s["threads_sink"] = with_(CORPUS, """SELECT conversation_id, turn_count, turn_count AS turns, brand_first_response FROM threads""")
    s["taxonomy_load"] = with_(base + [TAXONOMY, f"hit AS (SELECT unnest({matches('cleaned')}) AS name FROM customers)"],
      """SELECT priority, name, display_name, risk_level, default_action, (SELECT count(*) FROM hit h WHERE h.name = t.name) || ' messages' AS description,
      """ + "CASE priority " + " ".join(f"WHEN {i} THEN {q('|'.join(ex))}" for i, (_, _, _, _, ex) in enumerate(T.TAXONOMY, start=1))
      + " END AS examples, display_name AS resolution_patterns, risk_level AS escalation_conditions FROM taxonomy t")
    s["held_out_ids"] = with_(gold, "SELECT DISTINCT conversation_id FROM golden")
    s["golden_sink"] = s["golden_set"]
    s["index_store"] = s["search_topk"]
    s["index_deltas"] = s["search_topk"]
    s["result_record"] = with_(gold, """SELECT facet, value, count(*) AS n FROM (
        SELECT 'intent' AS facet, gold_intent AS value FROM golden UNION ALL SELECT 'decision', gold_decision FROM golden
        UNION ALL SELECT 'difficulty', difficulty FROM golden) GROUP BY ALL""")
    s["blank_query"] = with_(retrieve(1), found + " WHERE tweet_id % 3 = 2")
    return s
