"""The SQL each registered query must equal, written independently of the Spark code."""

from __future__ import annotations

import math

from msgrisk.constants import BANK_WORDS, CSV_MISSING, FLAG_ITEMS, FRAUD_PHRASES, LABEL_CLASSES, MANUAL_FEATURES, STOP_WORDS


def quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


SPACE = r"\s\x0B\x{85}\x1c-\x1f\p{Z}"
URL = rf"https?://[^{SPACE}]+|www\.[^{SPACE}]+"
SHORT = rf"(?:bit\.ly|tinyurl\.com|t\.co|goo\.gl|shorturl\.at|s\.id)/?[^{SPACE}]*"
PHONE = r"(?:\+?84|0)(?:\p{Nd}[ -]?){8,10}\p{Nd}"
MONEY = rf"(?:\p{{Nd}}+[\.,]?\p{{Nd}}*)[{SPACE}]*(?:vnđ|vnd|đ|dollar|usd|triệu|nghìn|k|m)"
ACCOUNT = r"(^|[^\pL\pN_])\p{Nd}{8,20}($|[^\pL\pN_])"
CAPITAL = r"[A-Z\x{C0}-\x{1EF8}]"
OTHER = rf"[^0-9a-zA-Z\x{{C0}}-\x{{1EF9}}\[\]{SPACE}_]+"


def digest(key: str, seed) -> str:
    return f"md5('{seed}:' || {key})"


def number(text: str, digits: int = 8) -> str:
    return f"('0x' || substr({text}, 1, {digits}))::BIGINT"


def unit(key: str, seed) -> str:
    return f"({number(digest(key, seed))} / 4294967296.0::DOUBLE)"


# Draws from the Poisson distribution of mean 1, from a uniform number u.
POISSON = " + ".join(
    f"(u >= '{sum(math.exp(-1) / math.factorial(j) for j in range(k + 1))!r}'::DOUBLE)::INTEGER" for k in range(13)
)


def features_of(source: str) -> str:
    """The ten features of every row of a relation with text, all other columns kept."""
    phrases = " + ".join(
        f"len(regexp_extract_all(_low, '{p.lower()}'))" for p in FRAUD_PHRASES
    )
    banks = " OR ".join(f"contains(_low, '{w}')" for w in BANK_WORDS)
    ratio = (
        f"coalesce(len(regexp_extract_all(_raw, '{CAPITAL}')) / nullif(len(regexp_extract_all(_raw, '\\pL')), 0), 0.0)"
    )
    flag = lambda c: f"CASE WHEN {c} THEN 1.0 ELSE 0.0 END::DOUBLE"
    return f"""SELECT * EXCLUDE (_raw, _low),
      {flag(f"regexp_matches(_raw, '{URL}', 'i')")} AS has_url,
      {flag(f"regexp_matches(_low, '{SHORT}', 'i')")} AS has_shorturl,
      {flag(f"regexp_matches(_raw, '{PHONE}')")} AS has_phone,
      {flag(f"regexp_matches(_low, '{MONEY}', 'i')")} AS has_money,
      {flag(f"regexp_matches(_raw, '{ACCOUNT}')")} AS has_bank_account,
      {flag(banks)} AS bank_mention,
      ({phrases})::DOUBLE AS fraud_keyword_count,
      len(regexp_extract_all(_raw, '!'))::DOUBLE AS exclamation_count,
      floor({ratio})::DOUBLE AS capslock_ratio,
      {ratio} AS caps_ratio,
      len(regexp_extract_all(_raw, '[^{SPACE}]+'))::DOUBLE AS msg_length
    FROM (SELECT *, coalesce(text, '') AS _raw, lower(coalesce(text, '')) AS _low FROM {source})"""


def cleaned_of(source: str) -> str:
    """normalized, toks, clean_text and token_count of every row of a relation with text."""
    masked = "lower(coalesce(text, ''))"
    for pattern, mask in ((URL, "URL"), (SHORT, "SHORTURL")):
        masked = f"regexp_replace({masked}, '{pattern}', ' [{mask}] ', 'gi')"
    masked = f"regexp_replace({masked}, '{PHONE}', ' [PHONE] ', 'g')"
    masked = f"regexp_replace({masked}, '{MONEY}', ' [MONEY] ', 'gi')"
    kept = f"replace(regexp_replace({masked}, '{OTHER}', ' ', 'g'), '_', ' ')"
    normalized = f"trim(regexp_replace({kept}, '[{SPACE}]+', ' ', 'g'))"
    return f"""SELECT *, array_to_string(toks, ' ') AS clean_text, len(toks)::INTEGER AS token_count FROM (
      SELECT *, [t for t in string_split(lower(normalized), ' ') if t <> '' AND NOT list_contains([{quoted(STOP_WORDS)}], t)] AS toks
      FROM (SELECT *, {normalized} AS normalized FROM {source}))"""


def marked(source: str, group: str, wanted: str, key: str, seed=42) -> str:
    """Rank rows of each group by hash."""
    return (
        f"SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY {digest(key, seed)}, {key}) AS pick "
        f"FROM {source}"
    )


ORDER_TEXT = """CASE o_orderkey % 4
  WHEN 0 THEN 'Vietcombank: tài khoản bị khóa! Click http://bit.ly/' || o_orderkey || ' để xác nhận OTP'
  WHEN 1 THEN 'Gọi 0912 345 ' || lpad(o_orderkey::VARCHAR, 7, '0')
       || ' nhận ' || floor(o_totalprice)::BIGINT || ' triệu ngay_liền!!'
  WHEN 2 THEN 'FREE free Click tinyurl.com/' || o_orderkey || ' chuyển tiền 12345678' || o_orderkey || ' và của'
  ELSE 'ĐƠN HÀNG ' || o_orderkey || ' TRỊ GIÁ ' || floor(o_totalprice)::BIGINT || ',5 USD' || chr(160) || 'mb bank t.co/x' END"""

FEATURES_SQL = ", ".join(MANUAL_FEATURES)

# Named relations; each may use those before it.
RELATIONS = {
    "sms": "SELECT conv_id * 1000 + turn AS msg_id, text, CASE WHEN role = 'system' THEN 'spam' ELSE 'ham' END AS label, "
           "'sms' AS source, 0::INTEGER AS source_rank FROM conversations",
    "email": "SELECT doc_id AS msg_id, text, CASE WHEN lang = 'en' THEN 'ham' ELSE 'spam' END AS label, "
             "'email' AS source, 1::INTEGER AS source_rank FROM documents",
    "merged": "SELECT * FROM sms UNION ALL SELECT * FROM email",
    "deduped": "SELECT * FROM merged QUALIFY row_number() OVER (PARTITION BY text ORDER BY source_rank, msg_id) = 1",
    "every": "SELECT msg_id, text FROM email UNION ALL SELECT 1000000000 + msg_id, text FROM sms UNION ALL "
             "SELECT 2000000000 + page_id, concat_ws(' ', url, html) FROM pages UNION ALL "
             f"SELECT 3000000000 + o_orderkey, {ORDER_TEXT} FROM orders",
    "docs": "SELECT doc_id AS msg_id, text, CASE lang WHEN 'en' THEN 0 WHEN 'fr' THEN 1 WHEN 'de' THEN 2 ELSE 3 END::INTEGER AS cluster_id, "
            f"round({unit('doc_id', 'probability')}, 4) AS fraud_probability FROM documents",
    "msgs": "SELECT d.*, CASE WHEN l.toxic = 1 THEN 'spam' ELSE 'ham' END AS label, "
            "CASE WHEN l.toxic = 1 THEN 1 ELSE 0 END::INTEGER AS y FROM docs d JOIN labels l ON d.msg_id = l.doc_id",
    "cleaned_docs": cleaned_of("docs"),
    "prepared": "SELECT * FROM (" + features_of("(" + cleaned_of("msgs") + ")") + ")",
    "gram_lists": "SELECT msg_id, u, u || [u[i] || ' ' || u[i + 1] for i in range(1, len(u))] AS grams "
                  "FROM (SELECT msg_id, regexp_extract_all(clean_text, '[\\pL\\pN_]+') AS u FROM prepared)",
    "all_gram_lists": "SELECT msg_id, u, u || [u[i] || ' ' || u[i + 1] for i in range(1, len(u))] AS grams "
                      "FROM (SELECT msg_id, regexp_extract_all(clean_text, '[\\pL\\pN_]+') AS u FROM cleaned_docs)",
    "grams": "SELECT msg_id, unnest(grams) AS term FROM gram_lists",
    "vocab": "SELECT term, count(*) AS tf, count(DISTINCT msg_id) AS df FROM grams GROUP BY term ORDER BY tf DESC, term LIMIT 5000",
    "raw_weights": "SELECT g.msg_id, g.term, count(*) * (ln((1 + (SELECT count(*) FROM prepared)) / (1 + any_value(v.df))) + 1) AS w "
                   "FROM grams g JOIN vocab v ON g.term = v.term GROUP BY ALL",
    "weights": "SELECT msg_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY msg_id)) AS weight FROM raw_weights",
    "bounds": "SELECT " + ", ".join(f"min({n}) AS low_{n}, max({n}) AS high_{n}" for n in MANUAL_FEATURES) + " FROM prepared",
    "held": "SELECT d.msg_id, d.item FROM (SELECT DISTINCT msg_id, unnest(toks) AS item FROM prepared WHERE y = 1) d SEMI JOIN vocab ON d.item = vocab.term"
            + "".join(f" UNION ALL SELECT msg_id, '{c}' FROM prepared WHERE y = 1 AND {c} <> 0" for c in FLAG_ITEMS),
    "transactions": "SELECT p.msg_id, list_sort(list(h.item) FILTER (h.item IS NOT NULL)) AS items FROM prepared p LEFT JOIN held h ON p.msg_id = h.msg_id "
                    "WHERE p.y = 1 GROUP BY p.msg_id",
    "least": "SELECT ceil(0.15::DOUBLE * count(*)) AS c, count(*) AS n FROM transactions",
    "one": "SELECT item AS a, count(*) AS n FROM held GROUP BY item HAVING count(*) >= (SELECT c FROM least)",
    "kept": "SELECT h.msg_id, h.item FROM held h SEMI JOIN one ON h.item = one.a",
    "two": "SELECT x.item AS a, y.item AS b, count(*) AS n FROM kept x JOIN kept y ON x.msg_id = y.msg_id AND x.item < y.item "
           "GROUP BY ALL HAVING count(*) >= (SELECT c FROM least)",
    "pairs_held": "SELECT x.msg_id, x.item AS a, y.item AS b FROM kept x JOIN kept y ON x.msg_id = y.msg_id AND x.item < y.item "
                  "SEMI JOIN two ON two.a = x.item AND two.b = y.item",
    "three": "SELECT p.a, p.b, z.item AS c, count(*) AS n FROM pairs_held p JOIN kept z ON p.msg_id = z.msg_id AND p.b < z.item "
             "GROUP BY ALL HAVING count(*) >= (SELECT c FROM least)",
    "itemsets": "SELECT [a] AS items, n FROM one UNION ALL SELECT [a, b], n FROM two UNION ALL SELECT [a, b, c], n FROM three",
    "splits": "SELECT [a] AS ante, [b] AS cons, n FROM two UNION ALL SELECT [b], [a], n FROM two "
              "UNION ALL SELECT [a], [b, c], n FROM three UNION ALL SELECT [b], [a, c], n FROM three "
              "UNION ALL SELECT [c], [a, b], n FROM three UNION ALL SELECT [b, c], [a], n FROM three "
              "UNION ALL SELECT [a, c], [b], n FROM three UNION ALL SELECT [a, b], [c], n FROM three",
    "rules": "SELECT ante, cons, s.n / least.n AS support, s.n / i.n AS confidence, (s.n / i.n) / (j.n / least.n) AS lift "
             "FROM splits s JOIN itemsets i ON i.items = s.ante JOIN itemsets j ON j.items = s.cons, least "
             "WHERE s.n / i.n >= 0.8::DOUBLE AND (s.n / i.n) / (j.n / least.n) >= 1.5::DOUBLE",
    "antes": f"SELECT ante, count(*) AS n_rules FROM rules WHERE NOT list_has_any(ante, [{quoted(FLAG_ITEMS)}]) GROUP BY ante",
    "ante_items": "SELECT ante, n_rules, len(ante) AS need, unnest(ante) AS item FROM antes",
    "hits": "SELECT msg_id, sum(n_rules)::INTEGER AS h FROM (SELECT p.msg_id, a.ante, a.need, a.n_rules FROM "
            "(SELECT msg_id, unnest(list_distinct(toks)) AS item FROM cleaned_docs) p JOIN ante_items a ON p.item = a.item "
            "GROUP BY ALL HAVING count(*) = a.need) GROUP BY msg_id",
    "risks": "SELECT cluster_id, avg(y) AS cluster_risk FROM msgs GROUP BY cluster_id",
    "scored": "SELECT p.msg_id, p.text, p.fraud_probability, p.cluster_id, coalesce(h.h, 0)::INTEGER AS rule_hits, "
              "least(greatest(0.6::DOUBLE * p.fraud_probability + 0.2::DOUBLE * coalesce(r.cluster_risk, 0.0) "
              "+ 0.2::DOUBLE * (least(coalesce(h.h, 0), 5) / 5.0::DOUBLE), 0), 1) AS score "
              "FROM docs p LEFT JOIN risks r ON p.cluster_id = r.cluster_id LEFT JOIN hits h ON p.msg_id = h.msg_id",
    "judged": "SELECT *, (fraud_probability >= 0.5)::INTEGER AS pred FROM msgs",
    "cells": "SELECT a.y, b.y AS pred, (SELECT count(*) FROM judged j WHERE j.y = a.y AND j.pred = b.y) AS n "
             "FROM (SELECT y FROM judged UNION SELECT pred FROM judged) a, (SELECT y FROM judged UNION SELECT pred FROM judged) b",
    "classes": "SELECT y, sum(n) AS support, sum(CASE WHEN y = pred THEN n ELSE 0 END) AS hit, "
               "(SELECT sum(n) FROM cells d WHERE d.pred = c.y) AS called FROM cells c GROUP BY y",
    "class_scores": "SELECT y, support, coalesce(hit / nullif(called, 0), 0) AS p, coalesce(hit / nullif(support, 0), 0) AS r, "
                    "coalesce(2 * hit / nullif(called + support, 0), 0) AS f, hit FROM classes",
    "emb": "SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings",
    "centres": "SELECT label, list(m ORDER BY i) AS c, any_value(n) AS n FROM (SELECT label, i, avg(x[i]) AS m, count(*) AS n "
               "FROM (SELECT label, x, unnest(range(1, len(x) + 1)) AS i FROM emb) GROUP BY label, i) GROUP BY label",
    "overall": "SELECT list(m ORDER BY i) AS c FROM (SELECT i, avg(x[i]) AS m FROM "
               "(SELECT x, unnest(range(1, len(x) + 1)) AS i FROM emb) GROUP BY i)",
    "assigned": "SELECT e.vec_id, e.x, arg_min(c.label, (list_distance(e.x, c.c), c.label)) AS cluster_id FROM emb e, centres c GROUP BY ALL",
    "pair_sums": "SELECT a.vec_id, a.label AS own, b.label AS other, sum(list_distance(a.x, b.x)) AS s, "
                 "count(*) - max((a.label = b.label)::INTEGER) AS n FROM emb a, emb b GROUP BY a.vec_id, a.label, b.label",
    "silhouette": "SELECT avg(CASE WHEN a IS NULL THEN 0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0) END) AS value FROM ("
                  "SELECT vec_id, max(CASE WHEN own = other THEN s / nullif(n, 0) END) AS a, min(CASE WHEN own <> other THEN s / n END) AS b "
                  "FROM pair_sums GROUP BY vec_id)",
    "pair_squares": "SELECT a.vec_id, a.label AS own, b.label AS other, sum(list_distance(a.x, b.x) ** 2) AS s, "
                    "count(*) - max((a.label = b.label)::INTEGER) AS n FROM emb a, emb b GROUP BY a.vec_id, a.label, b.label",
    "spreads": "SELECT e.label, avg(list_distance(e.x, c.c)) AS s, sum(list_distance(e.x, c.c) ** 2) AS w, any_value(c.n) AS n, any_value(c.c) AS c "
               "FROM emb e JOIN centres c ON e.label = c.label GROUP BY e.label",
    "db": "SELECT avg(worst) AS value FROM (SELECT a.label, max(coalesce((a.s + b.s) / nullif(list_distance(a.c, b.c), 0), 0)) AS worst "
          "FROM spreads a, spreads b WHERE a.label <> b.label GROUP BY a.label)",
    "ch": "SELECT sum(n * list_distance(s.c, o.c) ** 2) * (sum(n) - count(*)) / (sum(w) * (count(*) - 1)) AS value FROM spreads s, overall o",
    "keywords": "SELECT cluster_id, term, weight, row_number() OVER (PARTITION BY cluster_id ORDER BY round(weight, 9) DESC, term)::INTEGER AS rank "
                "FROM (SELECT m.cluster_id, w.term, sum(w.weight) / any_value(s.n) AS weight FROM weights w JOIN msgs m ON w.msg_id = m.msg_id "
                "JOIN (SELECT cluster_id, count(*) AS n FROM msgs GROUP BY cluster_id) s ON s.cluster_id = m.cluster_id GROUP BY m.cluster_id, w.term) "
                "QUALIFY rank <= 7",
    "examples": "SELECT cluster_id, msg_id, text, row_number() OVER (PARTITION BY cluster_id ORDER BY "
                + digest("msg_id", 42) + ", msg_id)::INTEGER AS example_rank FROM msgs QUALIFY example_rank <= 3",
    "report": "SELECT s.cluster_id, 'Nhóm liên quan tới ''' || k.words[1] || '''' AS suggested_name, s.n AS n_samples, k.words, e.texts FROM "
              "(SELECT cluster_id, count(*) AS n FROM msgs GROUP BY cluster_id) s "
              "JOIN (SELECT cluster_id, list(term ORDER BY rank) AS words FROM keywords GROUP BY cluster_id) k ON s.cluster_id = k.cluster_id "
              "JOIN (SELECT cluster_id, list(text ORDER BY example_rank) AS texts FROM examples GROUP BY cluster_id) e ON s.cluster_id = e.cluster_id",
    "nn": "SELECT a.vec_id, b.vec_id AS nn_id, list_distance(a.x, b.x) AS distance, row_number() OVER (PARTITION BY a.vec_id "
          "ORDER BY round(list_distance(a.x, b.x), 9), b.vec_id)::INTEGER AS nn_rank FROM emb a JOIN emb b ON a.vec_id <> b.vec_id QUALIFY nn_rank <= 5",
    "own_nn": "SELECT a.vec_id, a.label, a.x, b.x AS nn, b.vec_id AS nn_id, row_number() OVER (PARTITION BY a.vec_id "
              "ORDER BY round(list_distance(a.x, b.x), 9), b.vec_id) AS nn_rank FROM emb a JOIN emb b ON a.label = b.label AND a.vec_id <> b.vec_id QUALIFY nn_rank <= 5",
    "needs": "SELECT label, n, (max(n) OVER () - n) AS missing FROM (SELECT label, count(*) AS n FROM emb GROUP BY label)",
    "copies": "SELECT vec_id, label, unnest(range(1, c + 1)) AS copy FROM (SELECT e.vec_id, e.label, (q.missing // q.n + CASE WHEN row_number() OVER "
              f"(PARTITION BY e.label ORDER BY {digest('e.vec_id', 42)}, e.vec_id) <= q.missing % q.n THEN 1 ELSE 0 END) AS c "
              "FROM emb e JOIN needs q ON e.label = q.label)",
    "made": "SELECT c.vec_id || ':' || c.copy AS synth_id, c.vec_id, c.label FROM copies c",
    "lines": "SELECT m.synth_id, m.label, o.nn_id, o.x, o.nn, " + unit("m.synth_id", "42-position") + " AS u FROM made m JOIN own_nn o "
             "ON o.vec_id = m.vec_id AND o.nn_rank = " + number(digest("m.synth_id", "42-neighbour")) + " % 5 + 1",
}

# Which relations a relation reads, found by name.
def _needs(sql: str) -> list[str]:
    import re

    words = set(re.findall(r"[a-z_]+", sql))
    return [name for name in RELATIONS if name in words]


def with_relations(body: str) -> str:
    """Prefix a query with the relations it needs, directly or through others."""
    wanted: set[str] = set()
    todo = _needs(body)
    while todo:
        name = todo.pop()
        if name not in wanted:
            wanted.add(name)
            todo += [n for n in _needs(RELATIONS[name]) if n != name]
    parts = [f"{n} AS MATERIALIZED ({RELATIONS[n]})" for n in RELATIONS if n in wanted]
    return f"WITH {', '.join(parts)} {body}" if parts else body


SPELLED = (
    "[" + quoted(("spam", " FRAUD ", "Scam", "phishing\t", "Lừa đảo", "1", "ham", "legit", "Safe", "hợp lệ", "0", "1.0", "2", "Safe Email"))
    + "][doc_id % 14 + 1]"
)
CASES = " ".join(f"WHEN '{k}' THEN {v}" for k, v in LABEL_CLASSES.items())
CUT = ("CASE WHEN length({0}) > 200 THEN replace(substring({0}, 1, 200), chr(10), ' ') || '...' ELSE replace({0}, chr(10), ' ') END")
HITS_FROM_ID = "least(greatest(0.6::DOUBLE * fraud_probability + 0.2::DOUBLE * (cluster_id / 3.0::DOUBLE) + 0.2::DOUBLE * (least(msg_id % 8, 5) / 5.0::DOUBLE), 0), 1)"
BAND = "CASE WHEN {0} >= 0.8 THEN 'critical' WHEN {0} >= 0.6 THEN 'high' WHEN {0} >= 0.4 THEN 'medium' ELSE 'low' END"
TRAIN = f"{unit('msg_id', 42)} >= 0.2"

# Test-fold weights under a vocabulary fitted on the training fold.
TRANSFORM = f"""SELECT msg_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY msg_id)), 6) AS weight FROM (
  SELECT g.msg_id, g.term, count(*) * (ln((1 + (SELECT count(*) FROM prepared WHERE {TRAIN})) / (1 + any_value(v.df))) + 1) AS w
  FROM grams g JOIN (SELECT term, count(*) AS tf, count(DISTINCT msg_id) AS df FROM grams WHERE {TRAIN}
                     GROUP BY term ORDER BY tf DESC, term LIMIT 5000) v ON g.term = v.term
  WHERE NOT ({TRAIN.replace('msg_id', 'g.msg_id')}) GROUP BY g.msg_id, g.term)"""

SCALED_ALL = ", ".join(
    f"({n} - low_{n}) / coalesce(nullif(high_{n} - low_{n}, 0), 1) * 0.1::DOUBLE AS {n}" for n in MANUAL_FEATURES
)
TEST_SIZES = """SELECT y, n - base - CASE WHEN row_number() OVER (ORDER BY round(exact - base, 9) DESC, y) <= train - sum(base) OVER () THEN 1 ELSE 0 END AS wanted
  FROM (SELECT *, floor(exact)::BIGINT AS base FROM (SELECT y, n, total - ceil(0.2::DOUBLE * total)::BIGINT AS train, n * (total - ceil(0.2::DOUBLE * total)) / total AS exact
  FROM (SELECT y, count(*) AS n, sum(count(*)) OVER ()::BIGINT AS total FROM msgs GROUP BY y)))"""
QUALITY = """SELECT 'silhouette' AS metric, round(value, 4) AS value FROM silhouette
  UNION ALL SELECT 'davies_bouldin', round(value, 4) FROM db UNION ALL SELECT 'calinski_harabasz', round(value, 4) FROM ch
  UNION ALL SELECT 'inertia', (SELECT round(sum(w), 4) FROM spreads)"""

BODIES = {
    "csv_scan": "SELECT doc_id, md5(text) AS text_md5 FROM documents",
    "csv_bad_lines": "SELECT CASE doc_id % 4 WHEN 0 THEN 'ham' || doc_id ELSE 'spam' END AS v1, CASE doc_id % 4 WHEN 3 THEN md5(text) END AS v2_md5 "
                     "FROM documents WHERE doc_id % 4 IN (0, 3)",
    "load_messages": f"SELECT msg_id, source, label, md5(text) AS text_md5 FROM merged WHERE text NOT IN ({quoted(CSV_MISSING)})",
    "merge_sources": "SELECT msg_id, source, source_rank, md5(text) AS text_md5 FROM merged",
    "dedupe_messages": "SELECT msg_id, source, md5(text) AS text_md5 FROM deduped",
    "dataset_summary": "SELECT source || '_rows' AS metric, count(*) AS value FROM merged GROUP BY source UNION ALL SELECT 'total_rows', count(*) FROM deduped "
                       "UNION ALL SELECT 'removed_rows', (SELECT count(*) FROM merged) - (SELECT count(*) FROM deduped) "
                       "UNION ALL SELECT 'label_' || label, count(*) FROM deduped GROUP BY label",
    "label_counts": "SELECT label, count(*) AS n FROM msgs GROUP BY label",
    "coerce_labels": f"SELECT doc_id AS msg_id, coalesce(CASE v {CASES} END, trunc(try_cast(v AS DOUBLE)), -1)::INTEGER AS y FROM "
                     f"(SELECT doc_id, regexp_replace(lower({SPELLED}), '^\\s+|\\s+$', '', 'g') AS v FROM documents)",
    "normalize_text": f"SELECT msg_id, normalized FROM ({cleaned_of('every')})",
    "tokens": f"SELECT msg_id, token_count AS n, md5(clean_text) AS tokens_md5 FROM ({cleaned_of('every')})",
    "preprocess": f"SELECT msg_id, token_count, md5(clean_text) AS clean_md5, {FEATURES_SQL} FROM ({features_of('(' + cleaned_of('every') + ')')})",
    "message_features": f"SELECT msg_id, {FEATURES_SQL} FROM ({features_of('every')})",
    "caps_ratio_raw": f"SELECT msg_id, round(caps_ratio, 6) AS ratio FROM ({features_of('every')})",
    "feature_profile": "SELECT label, count(*) AS n, " + ", ".join(f"round(avg({n}), 6) AS avg_{n}" for n in [*MANUAL_FEATURES, "caps_ratio", "token_count"])
                       + " FROM prepared GROUP BY label",
    "fraud_rows": "SELECT msg_id, y FROM msgs WHERE y = 1",
    "cluster_source": "SELECT msg_id, y FROM msgs WHERE y = 1 OR NOT EXISTS (SELECT 1 FROM msgs WHERE y = 1)",
    "bag_weights": f"""SELECT bag, y, n, round(sum(n) OVER (PARTITION BY bag) / (count(*) OVER (PARTITION BY bag) * n), 6)::DOUBLE AS weight
      FROM (SELECT bag::INTEGER AS bag, y, sum({POISSON})::BIGINT AS n FROM (
        SELECT y, bag, {unit("(msg_id || ':' || bag)", "42-bag")} AS u FROM msgs, range(10) t(bag)) GROUP BY ALL) WHERE n > 0""",
    "class_weights": "SELECT y, round((SELECT count(*) FROM msgs) / ((SELECT count(DISTINCT y) FROM msgs) * count(*)), 6) AS weight FROM msgs GROUP BY y",
    "hash_split": f"SELECT msg_id, CASE WHEN {TRAIN} THEN 'train' ELSE 'test' END AS fold FROM msgs",
    "stratified_split": f"SELECT m.msg_id, m.y, CASE WHEN m.pick <= t.wanted THEN 'test' ELSE 'train' END AS fold FROM ({marked('msgs', 'y', '', 'msg_id')}) m "
                        f"JOIN ({TEST_SIZES}) t ON m.y = t.y",
    "capped_sample": f"SELECT msg_id FROM every ORDER BY {digest('msg_id', 42)}, msg_id LIMIT 10000",
    "manual_features_scaled": "SELECT p.msg_id, " + ", ".join(
        f"round(({n} - low_{n}) / coalesce(nullif(high_{n} - low_{n}, 0), 1) * 0.1::DOUBLE, 6) AS {n}" for n in MANUAL_FEATURES)
        + " FROM prepared p, (SELECT " + ", ".join(f"min({n}) AS low_{n}, max({n}) AS high_{n}" for n in MANUAL_FEATURES) + f" FROM prepared WHERE {TRAIN})",
    "tfidf_tokens": "SELECT msg_id, len(u)::INTEGER AS n, md5(array_to_string(u, ' ')) AS tokens_md5 FROM all_gram_lists",
    "ngrams": "SELECT msg_id, len(grams)::INTEGER AS n, md5(array_to_string(grams, '|')) AS grams_md5 FROM all_gram_lists",
    "vocabulary": "SELECT term, tf, df FROM vocab",
    "feature_names": "SELECT (row_number() OVER (ORDER BY term) - 1)::INTEGER AS idx, term FROM vocab UNION ALL "
                     f"SELECT ((SELECT count(*) FROM vocab) + i - 1)::INTEGER, [{quoted(MANUAL_FEATURES)}][i] FROM range(1, 11) t(i)",
    "tfidf_weights": "SELECT msg_id, term, round(weight, 6) AS weight FROM weights",
    "tfidf_transform": TRANSFORM,
    "tfidf_vectors": "SELECT p.msg_id, (SELECT count(*) FROM vocab)::INTEGER AS size, count(w.term)::INTEGER AS nnz, round(sqrt(coalesce(sum(w.weight ** 2), 0)), 6) AS l2norm "
                     "FROM prepared p LEFT JOIN weights w ON p.msg_id = w.msg_id GROUP BY p.msg_id",
    "feature_vectors": "SELECT s.msg_id, ((SELECT count(*) FROM vocab) + 10)::INTEGER AS size, (coalesce(t.k, 0) + len([v for v in s.vs if v <> 0]))::INTEGER AS nnz, "
                       "round(sqrt(coalesce(t.q, 0) + list_sum([v * v for v in s.vs])), 6) AS l2norm FROM "
                       f"(SELECT msg_id, [{FEATURES_SQL}] AS vs FROM (SELECT p.msg_id, {SCALED_ALL} FROM prepared p, bounds)) s LEFT JOIN "
                       "(SELECT msg_id, count(*) AS k, sum(weight ** 2) AS q FROM weights GROUP BY msg_id) t ON s.msg_id = t.msg_id",
    "transactions": "SELECT msg_id, coalesce(len(items), 0)::INTEGER AS n, coalesce(array_to_string(items, ' '), '') AS items FROM transactions",
    "frequent_itemsets": "SELECT array_to_string(items, '|') AS items, round(i.n / least.n, 6) AS support FROM itemsets i, least",
    "association_rules": "SELECT array_to_string(ante, '|') AS antecedents, array_to_string(cons, '|') AS consequents, round(support, 6) AS support, "
                         "round(confidence, 6) AS confidence, round(lift, 6) AS lift FROM rules",
    "top_rules": "SELECT * FROM (SELECT array_to_string(ante, '|') AS antecedents, array_to_string(cons, '|') AS consequents, round(support, 6) AS support, "
                 "round(confidence, 6) AS confidence, round(lift, 6) AS lift FROM rules) ORDER BY lift DESC, confidence DESC, support DESC, antecedents, consequents LIMIT 20",
    "rule_hits": "SELECT p.msg_id, coalesce(h.h, 0)::INTEGER AS rule_hits FROM docs p LEFT JOIN hits h ON p.msg_id = h.msg_id",
    "confusion_matrix": "SELECT y, pred, n FROM cells",
    "classification_report": "SELECT y::VARCHAR AS label, m AS metric, round(CASE m WHEN 'precision' THEN p WHEN 'recall' THEN r WHEN 'f1-score' THEN f ELSE support END::DOUBLE, 6) AS value "
                             "FROM class_scores, (SELECT unnest(['precision', 'recall', 'f1-score', 'support']) AS m) UNION ALL "
                             "SELECT 'accuracy', 'accuracy', round(sum(hit) / sum(support), 6) FROM class_scores UNION ALL "
                             "SELECT 'macro avg', m, round(CASE m WHEN 'precision' THEN avg(p) WHEN 'recall' THEN avg(r) WHEN 'f1-score' THEN avg(f) ELSE sum(support) END::DOUBLE, 6) "
                             "FROM class_scores, (SELECT unnest(['precision', 'recall', 'f1-score', 'support']) AS m) GROUP BY m UNION ALL "
                             "SELECT 'weighted avg', m, round(CASE m WHEN 'precision' THEN sum(p * support) / sum(support) WHEN 'recall' THEN sum(r * support) / sum(support) "
                             "WHEN 'f1-score' THEN sum(f * support) / sum(support) ELSE sum(support) END::DOUBLE, 6) "
                             "FROM class_scores, (SELECT unnest(['precision', 'recall', 'f1-score', 'support']) AS m) GROUP BY m",
    "roc_auc": "SELECT round((sum(CASE WHEN y = 1 THEN r END) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * (count(*) - sum(y))), 6) AS auc FROM "
               "(SELECT y, rank() OVER (ORDER BY fraud_probability) + (count(*) OVER (PARTITION BY fraud_probability) - 1) / 2 AS r FROM judged)",
    "assign_clusters": "SELECT vec_id, cluster_id FROM assigned",
    "cluster_sizes": "SELECT cluster_id, count(*) AS n FROM assigned GROUP BY cluster_id",
    "inertia": "SELECT round(sum(list_distance(a.x, c.c) ** 2), 6) AS value FROM assigned a JOIN centres c ON a.cluster_id = c.label",
    "silhouette_exact": "SELECT round(value, 6) AS value FROM silhouette",
    "davies_bouldin": "SELECT round(value, 6) AS value FROM db",
    "calinski_harabasz": "SELECT round(value, 6) AS value FROM ch",
    "cluster_quality": QUALITY,
    "quality_table": "SELECT CASE metric WHEN 'silhouette' THEN 'Silhouette Score' WHEN 'davies_bouldin' THEN 'Davies-Bouldin Index' "
                     "WHEN 'calinski_harabasz' THEN 'Calinski-Harabasz Index' ELSE 'Inertia (WCSS)' END AS \"Chỉ số\", value AS \"Giá trị đạt được\", "
                     "CASE metric WHEN 'silhouette' THEN 'Càng gần 1 càng tốt' WHEN 'davies_bouldin' THEN 'Càng nhỏ càng tốt' "
                     f"WHEN 'calinski_harabasz' THEN 'Càng lớn càng tốt' ELSE 'Tổng phương sai nội cụm' END AS \"Ý nghĩa\" FROM ({QUALITY})",
    "cluster_risk": "SELECT cluster_id, round(cluster_risk, 6) AS cluster_risk FROM risks",
    "cluster_keywords": "SELECT cluster_id, term, round(weight, 6) AS weight, rank FROM keywords",
    "cluster_examples": "SELECT cluster_id, msg_id, row_number() OVER (PARTITION BY cluster_id ORDER BY "
                        + digest("msg_id", 42) + ", msg_id)::INTEGER AS example_rank FROM docs QUALIFY example_rank <= 3",
    "cluster_report": "SELECT cluster_id, suggested_name, n_samples, array_to_string(words, '|') AS top_keywords, md5(array_to_string(texts, '|')) AS examples_md5 FROM report",
    "cluster_table": "SELECT cluster_id AS \"Cụm\", suggested_name AS \"Tên gợi ý\", n_samples AS \"Số mẫu\", array_to_string(words, ', ') AS \"Từ khóa đặc trưng\", "
                     + ", ".join(f"coalesce(texts[{i}], '') AS \"Ví dụ {i}\"" for i in (1, 2, 3)) + " FROM report",
    "cluster_markdown": "SELECT cluster_id, '## Cụm ' || cluster_id || ': ' || suggested_name || chr(10) || '- **Số mẫu:** ' || n_samples || chr(10) "
                        "|| '- **Từ khóa đặc trưng:** ' || array_to_string(words, ', ') || chr(10) || '- **Ví dụ tin nhắn:**' || chr(10) || "
                        + " || ".join(f"coalesce('  {i}. ' || {CUT.format(f'texts[{i}]')} || chr(10), '')" for i in (1, 2, 3))
                        + " || chr(10) || '---' || chr(10) AS value FROM report",
    "smote_neighbors": "SELECT vec_id, nn_id, nn_rank, round(distance, 6) AS distance FROM nn",
    "smote_rows": "SELECT synth_id, label, nn_id, (i - 1)::INTEGER AS pos, round(x[i] + u * (nn[i] - x[i]), 6) AS value FROM (SELECT *, unnest(range(1, len(x) + 1)) AS i FROM lines)",
    "risk_score": f"SELECT msg_id, round({HITS_FROM_ID}, 6) AS risk_score FROM docs",
    "severity": f"SELECT msg_id, {BAND.format('s')} AS severity FROM (SELECT msg_id, round({HITS_FROM_ID}, 6) AS s FROM docs)",
    "score_messages": f"SELECT msg_id, md5(text) AS text_md5, fraud_probability, cluster_id, round(score, 6) AS risk_score, {BAND.format('score')} AS severity FROM scored",
    "alerts": f"SELECT msg_id, round(score, 6) AS risk_score, {BAND.format('score')} AS severity, 'Cluster ' || cluster_id || CASE WHEN rule_hits > 0 "
              "THEN '|Matched ' || rule_hits || ' suspicious association rules' ELSE '' END AS reasons FROM scored",
    "pca_norms": """SELECT vec_id, round(sum((x - m) * (x - m)), 6) AS norm FROM (
        SELECT vec_id, x, avg(x) OVER (PARTITION BY place) AS m FROM (
          SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS place FROM embeddings)) GROUP BY vec_id""",
    "stream_dedupe_ranked": "SELECT msg_id, source, md5(text) AS text_md5 FROM deduped",
    "stream_dedupe": "SELECT DISTINCT md5(text) AS text_md5 FROM documents",
}
BODIES["silhouette_fast"] = (
    "SELECT round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS value FROM ("
    "SELECT vec_id, max(CASE WHEN own = other THEN s / nullif(n, 0) END) AS a, min(CASE WHEN own <> other THEN s / n END) AS b "
    "FROM pair_squares GROUP BY vec_id)"
)
BODIES["stream_score"] = BODIES["score_messages"]
