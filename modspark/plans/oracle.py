"""The registered queries in plain SQL for DuckDB, written independently of the operators.

Differences between the engines are spelled out: RE2 has ASCII classes and no look-around,
so whitespace and word edges are written as character sets.
"""

from __future__ import annotations

from modspark import constants as K

SQL: dict[str, str] = {}

# --- shared fragments -------------------------------------------------------

SPACE = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
URL = rf"https?://[^{SPACE}]+|www\.[^{SPACE}]+"
PHONE = (
    rf"\b(?:\+?\d{{1,3}}[{SPACE}-]?)?(?:\(\d{{2,4}}\)[{SPACE}-]?)?"
    rf"\d{{2,4}}[{SPACE}-]?\d{{2,4}}[{SPACE}-]?\d{{2,4}}\b"
)


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def norm(text: str) -> str:
    return f"trim(regexp_replace(coalesce({text}, ''), {q(f'[{SPACE}]+')}, ' ', 'g'), ' ')"


def strip(text: str) -> str:
    return f"regexp_replace({text}, {q(f'^[{SPACE}]+|[{SPACE}]+$')}, '', 'g')"


def redact(text: str) -> str:
    for pattern, mask in ((EMAIL, "<EMAIL>"), (URL, "<URL>"), (PHONE, "<PHONE>")):
        text = f"regexp_replace({text}, {q(pattern)}, {q(mask)}, 'g')"
    return text


def uniform(text_hash: str, label: str, salt: str) -> str:
    digest = f"sha256({text_hash} || '|{salt}|' || {label})"
    return f"(CAST('0x' || substr({digest}, 1, 6) AS BIGINT) / 16777216::DOUBLE)"


def order_key(column: str, seed: int = 42) -> str:
    return f"CAST('0x' || substr(sha256('{seed}|' || {column}), 1, 15) AS BIGINT)"


def fraction(column: str, seed: int = 42) -> str:
    return f"(({order_key(column, seed)} >> 8) / 4503599627370496::DOUBLE)"


def f1(tp: str, fp: str, fn: str) -> str:
    whole = f"(2 * {tp} + {fp} + {fn})"
    return f"CASE WHEN {whole} = 0 THEN 0 ELSE (2 * {tp})::DOUBLE / {whole} END"


def kept(part: str, pattern: str) -> str:
    return f"length(regexp_replace({part}, {q(pattern)}, '', 'g'))"


LABELLED = """
labelled AS (
  SELECT d.doc_id, d.text, d.lang, l.toxic, l.quality, sha256(d.text) AS h
  FROM documents d JOIN labels l USING (doc_id))"""


def long(salt: str = "eval", name: str = "long") -> str:
    rows = " UNION ALL ".join(
        f"SELECT doc_id, text, '{x}' AS label, {x} AS y, "
        f"CAST(0.7::DOUBLE * {uniform('h', q(x), salt)} + 0.3::DOUBLE * {x} AS FLOAT) AS p FROM labelled"
        for x in ("toxic", "quality")
    )
    return f"{name} AS ({rows})"


def counts(source: str, keys: str = "label", cut: str = "0.5::FLOAT") -> str:
    """Per-label confusion counts and the pairwise-rank AUC of a long table."""
    return f"""
ranked AS (
  SELECT *, avg(rn) OVER (PARTITION BY {keys}, p) AS mid
  FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY p) AS rn FROM {source}) r),
counted AS (
  SELECT {keys}, count(*) AS n, sum(y)::BIGINT AS positives,
    count(*) FILTER (y = 1 AND p >= {cut}) AS tp, count(*) FILTER (y = 0 AND p >= {cut}) AS fp,
    count(*) FILTER (y = 1 AND p < {cut}) AS fn, count(*) FILTER (y = 0 AND p < {cut}) AS tn,
    CASE WHEN min(y) <> max(y) THEN
      (sum(CASE WHEN y = 1 THEN mid END) - sum(y) * (sum(y) + 1) / 2::DOUBLE)
      / (sum(y)::DOUBLE * (count(*) - sum(y))) END AS auc
  FROM ranked GROUP BY {keys})"""


BASE = f"WITH {LABELLED}, {long()}"
COUNTED = f"{BASE}, {counts('long')}"
F1_ROW = f1("tp", "fp", "fn")
F1_MICRO = f1("sum(tp)", "sum(fp)", "sum(fn)")

# --- sources, cleaning, labels ---------------------------------------------

SIGNED = """
signed AS (
  SELECT d.doc_id, d.text, l.toxic::VARCHAR AS toxic, l.quality - l.toxic AS margin
  FROM documents d LEFT JOIN labels l USING (doc_id))"""
PREPARED = f"""
prepared AS (
  SELECT doc_id, {norm('text')} AS text, toxic::DOUBLE AS y_toxic, margin::DOUBLE AS y_margin
  FROM signed WHERE toxic IS NOT NULL AND toxic::DOUBLE >= 0 AND margin >= 0)"""

SQL["load_splits"] = "SELECT 'train' AS split, doc_id, toxic, quality FROM labels"
SQL["export_splits"] = f"""
SELECT doc_id, quality, toxic, CASE WHEN spot < 0.9::DOUBLE THEN 'train'
  WHEN spot < 0.9::DOUBLE + 0.05::DOUBLE THEN 'validation' ELSE 'test' END AS split
FROM (SELECT *, {fraction('doc_id')} AS spot FROM labels)"""
SQL["prepare_normalize"] = f"""
SELECT doc_id, sha256(t) AS norm_sha256, length(t) AS norm_length
FROM (SELECT doc_id, {norm('text')} AS t FROM documents)"""
SQL["prepare_label_vector"] = f"""
WITH {SIGNED}
SELECT doc_id, coalesce(toxic::DOUBLE, 0) AS v0, coalesce(margin::DOUBLE, 0) AS v1,
  coalesce(try_cast(text AS DOUBLE), 0) AS v2, 0::DOUBLE AS v3 FROM signed"""
SQL["prepare_labeled_only"] = f"""
WITH {SIGNED}, {PREPARED}
SELECT doc_id, sha256(text) AS text_sha256, y_toxic, y_margin,
  (y_toxic > 0 OR y_margin > 0) AS any_positive, NOT (y_toxic > 0 OR y_margin > 0) AS all_zero
FROM prepared"""

CLASSES = f"""
classes AS (
  SELECT substr(sha256(t), 1, 12) AS id, t, class_id, split,
    CASE class_id WHEN 1 THEN 'OFFENSIVE' WHEN 2 THEN 'HATE' ELSE 'CLEAN' END AS class_name,
    length(t) AS char_len
  FROM (
    SELECT {norm('d.text')} AS t,
      CASE WHEN l.toxic = 1 AND l.quality = 1 THEN 1 WHEN l.toxic = 1 THEN 2
           WHEN l.quality = 1 THEN 1 ELSE 0 END AS class_id,
      CASE d.lang WHEN 'en' THEN 'train' WHEN 'fr' THEN 'validation' WHEN 'de' THEN 'test'
           ELSE 'holdout' END AS split
    FROM documents d LEFT JOIN labels l USING (doc_id)) c)"""
SQL["class_parse_multi_hot"] = f"""
WITH {CLASSES}
SELECT id, class_id, class_name, split, char_len,
  CASE WHEN class_id = 1 THEN 1 ELSE 0 END::DOUBLE AS y_offensive,
  CASE WHEN class_id = 2 THEN 1 ELSE 0 END::DOUBLE AS y_hate FROM classes"""
SQL["split_alias"] = f"WITH {CLASSES} SELECT split, count(*) AS n FROM classes GROUP BY split"
SQL["split_filter"] = f"WITH {CLASSES} SELECT id, class_name FROM classes WHERE split = 'validation'"
SQL["short_id"] = f"SELECT doc_id, substr(sha256({norm('text')}), 1, 12) AS short_id FROM documents"
SQL["cap_rows"] = f"SELECT doc_id, lang FROM documents ORDER BY {order_key('doc_id')} LIMIT 100"
SQL["label_rekey"] = "SELECT doc_id, " + ", ".join(
    (
        f"round(CAST({uniform('sha256(text)', q(K.SCORER_LABEL_RENAMES.get(x, x)), 'map')} AS FLOAT)::DOUBLE, 6) AS {x}"
        if x != "severe_toxic"
        else "0::DOUBLE AS severe_toxic"
    )
    for x in K.ENGLISH_LABELS
) + " FROM documents"
SQL["sigmoid_scores"] = """
SELECT doc_id, round(1 / (1 + exp(-((n_chars - 2000) / 1000::DOUBLE))), 6) AS p FROM documents"""

# --- sampling and splitting -------------------------------------------------

SQL["downsample_negatives"] = f"""
WITH neg AS (
  SELECT doc_id, row_number() OVER (ORDER BY {order_key('doc_id')}) AS rn, count(*) OVER () AS n
  FROM labels WHERE toxic = 0)
SELECT doc_id, toxic::DOUBLE AS toxic FROM labels WHERE toxic > 0
UNION ALL SELECT doc_id, 0::DOUBLE FROM neg WHERE rn <= floor(n * 0.37::DOUBLE)"""
SQL["hash_split"] = f"""
SELECT doc_id, CASE WHEN spot < 0.9::DOUBLE THEN 'train' WHEN spot < 0.9::DOUBLE + 0.05::DOUBLE THEN 'validation'
  ELSE 'test' END AS split FROM (SELECT doc_id, {fraction('doc_id')} AS spot FROM documents)"""
SQL["hash_split_no_test"] = f"""
SELECT doc_id, CASE WHEN {fraction('doc_id')} < 0.9::DOUBLE THEN 'train' ELSE 'validation' END AS split
FROM documents"""
SQL["supplied_splits"] = """
SELECT doc_id, CASE WHEN lang = 'fr' THEN 'validation' WHEN lang = 'de' THEN 'test' ELSE 'train' END AS split
FROM labels JOIN documents USING (doc_id)"""
SQL["eval_split_fallback"] = f"""
SELECT doc_id, 'validation' AS split FROM labels WHERE {fraction('doc_id')} >= 0.9::DOUBLE"""
SQL["class_split_fallback"] = f"""
WITH {CLASSES}
SELECT id, CASE WHEN spot < 0.8::DOUBLE THEN 'train' WHEN spot < 0.8::DOUBLE + 0.1::DOUBLE THEN 'validation'
  ELSE 'test' END AS split, count(*) AS n
FROM (SELECT id, {fraction('id')} AS spot FROM classes) GROUP BY ALL"""
SQL["seeded_shuffle"] = f"""
SELECT doc_id, {order_key('doc_id')} AS order_key FROM documents ORDER BY order_key, doc_id"""
SQL["export_shards"] = f"""
SELECT doc_id, row_number() OVER (ORDER BY {order_key('doc_id')}, doc_id) - 1 AS position FROM documents"""
SQL["load_prepared"] = f"""
WITH {SIGNED}, {PREPARED},
neg AS (
  SELECT *, row_number() OVER (ORDER BY {order_key('doc_id')}) AS rn, count(*) OVER () AS n
  FROM prepared WHERE NOT (y_toxic > 0 OR y_margin > 0)),
sampled AS (
  SELECT doc_id, text, y_toxic, y_margin FROM prepared WHERE y_toxic > 0 OR y_margin > 0
  UNION ALL SELECT doc_id, text, y_toxic, y_margin FROM neg WHERE rn <= floor(n * 0.5::DOUBLE))
SELECT doc_id, sha256(text) AS text_sha256, y_toxic, y_margin,
  CASE WHEN spot < 0.9::DOUBLE THEN 'train' WHEN spot < 0.9::DOUBLE + 0.05::DOUBLE THEN 'validation'
  ELSE 'test' END AS split
FROM (SELECT *, {fraction('doc_id')} AS spot FROM sampled)"""

# --- text features ----------------------------------------------------------


def features(text: str) -> dict[str, str]:
    clean, size = norm(text), f"length({text})"
    alpha = kept(text, r"[^\p{L}]")
    punct = "[" + "".join("\\" + c for c in K.PUNCTUATION) + "]"
    return {
        "length_chars": size,
        "length_words": f"CASE WHEN {clean} = '' THEN 0 ELSE len(string_split({clean}, ' ')) END",
        "uppercase_ratio": f"CASE WHEN {alpha} = 0 THEN 0 ELSE CAST({kept(text, r'[^\p{Lu}]')}::DOUBLE / {alpha} AS FLOAT) END",
        "punct_ratio": f"CASE WHEN {size} = 0 THEN 0 ELSE CAST(({size} - {kept(text, punct)})::DOUBLE / {size} AS FLOAT) END",
        "exclam": f"{size} - {kept(text, '!')}",
        "question": f"{size} - {kept(text, '[?]')}",
        "has_url": f"CAST(regexp_matches({text}, {q('(?i)' + URL)}) AS INT)",
        "has_email": f"CAST(regexp_matches({text}, {q('(?i)' + EMAIL)}) AS INT)",
        "has_repeat": repeat(text),
        "non_ascii_ratio": f"CASE WHEN {size} = 0 THEN 0 ELSE CAST({kept(text, r'[\x00-\x7f]')}::DOUBLE / {size} AS FLOAT) END",
        "has_quote": f"CAST(contains({text}, '\"') OR contains({text}, chr(39)) AS INT)",
    }


def repeat(text: str) -> str:
    """RE2 has no back-reference: look for three equal neighbours in the list of characters."""
    chars = f"string_split({text}, '')"
    triple = f"list_zip({chars}, {chars}[2:], {chars}[3:])"
    return (
        f"CAST(len(list_filter({triple}, "
        f"lambda t: t[1] = t[2] AND t[2] = t[3] AND t[1] <> chr(10))) > 0 AS INT)"
    )


RATIOS = ("uppercase_ratio", "punct_ratio", "non_ascii_ratio")
SQL["text_features"] = "SELECT doc_id, " + ", ".join(
    f"round(({sql})::DOUBLE, 6) AS {name}" if name in RATIOS else f"{sql} AS {name}"
    for name, sql in features("text").items()
    if name != "has_repeat"
) + " FROM documents"
SQL["feature_repeat"] = f"SELECT doc_id, {repeat('text')} AS has_repeat FROM documents"
SQL["redact_pii"] = f"""
SELECT doc_id, sha256(t) AS sha256, length(t) AS length
FROM (SELECT doc_id, {redact('text')} AS t FROM documents)"""
SQL["redact_pages"] = f"""
SELECT page_id, sha256(t) AS sha256, length(t) AS length
FROM (SELECT page_id, {redact("(url || ' ' || html)")} AS t FROM pages)"""
SQL["content_hash"] = "SELECT doc_id, sha256(text) AS sha256 FROM documents"


def mention(terms: list[str]) -> str:
    return f"regexp_matches(text, {q(r'(?i)(^|[^\p{L}\p{N}_])(' + '|'.join(terms) + r')([^\p{L}\p{N}_]|$)')})"


TERMS = {
    "articles": ["the", "le", "der"],
    "verbs": ["was", "est", "ist"],
    "copulas": ["that", "which"],
    "nobody": ["zyzzyva"],
}
ANY_TERM = " OR ".join(mention(t) for t in TERMS.values())


def membership(source: str, columns: str) -> str:
    rows = [f"SELECT {columns}, '{g}' AS slice FROM {source} WHERE {mention(t)}" for g, t in TERMS.items()]
    rows.append(f"SELECT {columns}, '{K.ANY_SLICE}' FROM {source} WHERE {ANY_TERM}")
    rows.append(f"SELECT {columns}, '{K.REFERENCE_SLICE}' FROM {source} WHERE NOT ({ANY_TERM})")
    return " UNION ALL ".join(rows)


SQL["slice_membership"] = membership("documents", "doc_id")
SQL["slice_membership_terms"] = SQL["slice_membership"]

MESSAGES = f"""
messages AS (
  SELECT doc_id, text, n_chars, CASE
    WHEN length({strip('text')}) < 3 OR source = 'src3' OR lang IS NULL OR lang = '' THEN 'unknown'
    WHEN lang = 'es' THEN 'vi-VN' WHEN lang = 'en' THEN 'en-US' ELSE lang END AS lang
  FROM documents)"""
SQL["language_rules"] = f"""
WITH {MESSAGES}
SELECT doc_id, lang, starts_with(lower(lang), 'en') AS is_english,
  starts_with(lower(lang), 'vi') AS is_vietnamese FROM messages"""

LANGUAGES = f"""
clean AS (SELECT doc_id, lang, string_split(lower({norm('text')}), '') AS c FROM documents),
grams AS (
  SELECT doc_id, lang, unnest(list_transform(range(1, len(c) - 1), lambda i: c[i] || c[i + 1] || c[i + 2])) AS gram
  FROM clean),
by_lang AS (SELECT lang, gram, count(*) AS c FROM grams GROUP BY lang, gram),
size AS (SELECT count(DISTINCT gram) AS v FROM grams),
totals AS (SELECT lang, sum(c) + any_value(v) AS n FROM by_lang, size GROUP BY lang),
seen AS (SELECT doc_id, gram, count(*) AS k FROM grams GROUP BY doc_id, gram),
sums AS (
  SELECT s.doc_id, t.lang, sum(k * ln((coalesce(b.c, 0) + 1) / n::DOUBLE)) AS s
  FROM seen s CROSS JOIN totals t LEFT JOIN by_lang b ON b.lang = t.lang AND b.gram = s.gram
  GROUP BY s.doc_id, t.lang),
best AS (SELECT doc_id, arg_max(lang, s) AS lang FROM sums GROUP BY doc_id)"""
SQL["language_id"] = f"""
WITH {LANGUAGES}
SELECT doc_id, coalesce(best.lang, 'unknown') AS detected FROM documents LEFT JOIN best USING (doc_id)"""
SQL["language_id_in_place"] = SQL["language_id"]

# --- moderation -------------------------------------------------------------

SQL["batch_scorer"] = "SELECT doc_id, " + ", ".join(
    f"CASE WHEN lang = 'en' THEN round(CAST({uniform('sha256(text)', q(x), 'batch')} AS FLOAT)::DOUBLE, 6) END AS p_{x}"
    for x in ("toxic", "quality")
) + " FROM documents"


def score_rows(salt: str, labels: tuple[str, ...]) -> str:
    names = ", ".join(f"({i}, '{x}')" for i, x in enumerate(labels))
    u = uniform("h", "label", salt)
    return (
        f"SELECT doc_id, '{salt}' AS salt, place, label, CAST(u * u * u * u AS FLOAT)::DOUBLE AS score FROM "
        f"(SELECT doc_id, place, label, {u} AS u FROM hashed CROSS JOIN (VALUES {names}) v(place, label))"
    )


MODERATION = f"""
hashed AS (SELECT *, sha256(text) AS h FROM messages),
scores AS MATERIALIZED (
  {score_rows('fast', K.ENGLISH_LABELS)} UNION ALL {score_rows('multi', K.ENGLISH_LABELS)}
  UNION ALL {score_rows('tuned', K.ENGLISH_LABELS)} UNION ALL {score_rows('vi', K.VIETNAMESE_LABELS)}),
fast AS (SELECT doc_id, max(score) AS fast FROM scores WHERE salt = 'fast' GROUP BY doc_id),
judged AS (
  SELECT m.*, fast, fast BETWEEN 0.35::DOUBLE AND 0.65::DOUBLE AS borderline,
    (fast BETWEEN 0.35::DOUBLE AND 0.65::DOUBLE OR fast >= 0.85::DOUBLE OR lang = 'unknown' OR lower(lang) = 'vi')
      AS need
  FROM hashed m JOIN fast USING (doc_id)),
routed AS (
  SELECT *, CASE WHEN lower(lang) LIKE 'vi%' THEN 'vi' WHEN need AND lower(lang) NOT LIKE 'en%' THEN 'multi'
    WHEN need THEN 'tuned' ELSE 'fast' END AS salt FROM judged),
final AS (SELECT r.*, place, label, score FROM routed r JOIN scores s USING (doc_id, salt)),
overall AS (SELECT doc_id, max(score) AS overall_score, count(*) AS n_labels FROM final GROUP BY doc_id),
acted AS (
  SELECT *, CASE WHEN overall_score < 0.3::DOUBLE THEN 'ALLOW' WHEN overall_score < 0.6::DOUBLE THEN 'WARN'
    ELSE 'BLOCK' END AS base,
    CASE salt WHEN 'vi' THEN 'vi_finetuned:vi' WHEN 'tuned' THEN 'finetuned:tuned'
      ELSE 'detoxify:' || salt END AS model_used
  FROM routed JOIN overall USING (doc_id)),
decided AS (
  SELECT *, (lang = 'unknown' OR (borderline AND base <> 'ALLOW')) AS request_human_review,
    CASE WHEN lang = 'unknown' OR (borderline AND base <> 'ALLOW') THEN 'REVIEW' ELSE base END AS action
  FROM acted)"""
MODERATED = f"WITH {MESSAGES}, {MODERATION}"
MESSAGE_CASE = "CASE action " + " ".join(
    f"WHEN {q(a)} THEN {q(m)}" for a, m in K.ACTION_MESSAGES.items()
) + " END"
NAME_CASE = "CASE label " + " ".join(
    f"WHEN {q(x)} THEN {q(n)}" for x, n in K.LABEL_DISPLAY_NAMES.items()
) + " END"

SQL["moderate_batch"] = f"""{MODERATED}
SELECT doc_id, action, round(overall_score, 6) AS overall_score, n_labels, model_used, lang AS language,
  {MESSAGE_CASE} AS policy_message, request_human_review FROM decided"""
SQL["moderate_routes"] = f"""{MODERATED}
SELECT lang AS language, CASE salt WHEN 'multi' THEN 'multilingual' WHEN 'tuned' THEN 'finetuned' ELSE salt END AS route,
  model_used, borderline AS is_borderline, count(*) AS n, round(avg(fast), 6) AS mean_fast
FROM decided GROUP BY ALL"""
SQL["label_scores"] = f"{MODERATED} SELECT doc_id, label, round(score, 6) AS score FROM final"
SQL["explanations"] = f"""{MODERATED},
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, place) AS rn FROM final)
SELECT doc_id, 'Top signals -> ' || string_agg({NAME_CASE} || ': ' || printf('%.2f', score), ', ' ORDER BY rn)
  AS explanation FROM best WHERE rn <= 3 GROUP BY doc_id"""
SQL["review_queue"] = f"""{MODERATED}
SELECT '2024-01-01T00:00:00.000000' AS ts_utc, h AS text_sha256, lang AS language,
  round(overall_score, 6) AS overall_score, model_used, n_labels FROM decided WHERE request_human_review"""
SQL["prediction_log"] = f"""{MODERATED}
SELECT '2024-01-02T03:04:05.678000' AS ts_utc, h AS text_sha256, action,
  round(overall_score, 6) AS overall_score, lang AS language, request_human_review, false AS has_text
FROM decided"""
SQL["prediction_log_redacted"] = f"""
SELECT sha256(text) AS text_sha256, sha256({redact('text')}) AS redacted_sha256 FROM documents"""
SQL["committed_log"] = f"""{MODERATED}
SELECT action, 2 * count(*) AS n, 2 * sum(length(coalesce(text, '')))::BIGINT AS chars FROM decided GROUP BY action"""
SQL["request_texts"] = """
SELECT conv_id, turn, 0 AS pos, sha256(text) AS sha256 FROM conversations WHERE role <> 'system'
UNION ALL
SELECT conv_id, turn, 1, sha256('assistant: ' || text) FROM conversations WHERE role = 'assistant'"""

# --- metrics ----------------------------------------------------------------

SQL["binarize"] = f"{BASE} SELECT doc_id, label, CAST(p >= 0.5::FLOAT AS INT) AS pred FROM long"
SQL["confusion"] = f"{COUNTED} SELECT label, n, tp, fp, fn, tn FROM counted"
SQL["f1"] = f"""{COUNTED}
SELECT round({F1_MICRO}, 6) AS f1_micro, round(avg({F1_ROW}), 6) AS f1_macro FROM counted"""
SQL["auc"] = f"{COUNTED} SELECT label, n, positives, round(auc, 6) AS auc FROM counted"
SQL["evaluate"] = f"""{COUNTED}
SELECT max(n) AS n, round({F1_MICRO}, 6) AS f1_micro, round(avg({F1_ROW}), 6) AS f1_macro,
  round(avg(auc), 6) AS auc_macro FROM counted"""
SQL["compare_models"] = f"""
WITH {LABELLED}, {long('baseline', 'a')}, {long('finetuned', 'b')},
both_models AS (SELECT 'baseline' AS model, * FROM a UNION ALL SELECT 'finetuned', * FROM b),
{counts('both_models', 'model, label')},
per AS (
  SELECT model, max(n) AS n, round({F1_MICRO}, 6) AS f1_micro, round(avg({F1_ROW}), 6) AS f1_macro,
    round(avg(auc), 6) AS auc_macro FROM counted GROUP BY model)
SELECT model, n, f1_micro, f1_macro, auc_macro, CASE WHEN n IS NULL THEN 'no predictions' ELSE '' END AS note
FROM (VALUES ('baseline'), ('off_the_shelf'), ('finetuned')) m(model) LEFT JOIN per USING (model)"""
SQL["prevalence"] = """
SELECT 'toxic' AS label, count(*) AS n, round(avg(toxic), 6) AS positive_rate FROM labels
UNION ALL SELECT 'quality', count(*), round(avg(quality), 6) FROM labels"""
SQL["split_summary"] = f"""
WITH {CLASSES}
SELECT split, count(*) AS n_rows, count(*) FILTER (class_id = 0) AS clean,
  count(*) FILTER (class_id = 1) AS offensive, count(*) FILTER (class_id = 2) AS hate,
  round(avg(char_len), 6) AS avg_char_len, CAST(floor(quantile_cont(char_len, 0.95)) AS INT) AS p95_char_len
FROM classes GROUP BY split"""

GRID = f"""
grid AS (SELECT unnest([{', '.join(f'{t}::DOUBLE' for t in K.THRESHOLD_GRID)}]) AS threshold),
tried AS (
  SELECT label, threshold, count(*) FILTER (y = 1 AND p >= threshold::FLOAT) AS tp,
    count(*) FILTER (y = 0 AND p >= threshold::FLOAT) AS fp, count(*) FILTER (y = 1 AND p < threshold::FLOAT) AS fn
  FROM long CROSS JOIN grid GROUP BY label, threshold),
per_label AS (
  SELECT label, threshold, f1 FROM (
    SELECT label, threshold, {F1_ROW} AS f1,
      row_number() OVER (PARTITION BY label ORDER BY {F1_ROW} DESC, threshold) AS rn FROM tried) WHERE rn = 1),
global AS (
  SELECT threshold, {F1_MICRO} AS f1_micro, avg({F1_ROW}) AS f1_macro FROM tried GROUP BY threshold
  ORDER BY f1_micro DESC, threshold LIMIT 1)"""
SQL["threshold_per_label"] = f"{BASE}, {GRID} SELECT label, threshold, round(f1, 6) AS f1 FROM per_label"
SQL["threshold_global"] = f"""{BASE}, {GRID}
SELECT threshold, round(f1_micro, 6) AS f1_micro, round(f1_macro, 6) AS f1_macro FROM global"""
SQL["threshold_apply"] = f"""{BASE}, {GRID}
SELECT label, count(*) AS n, count(*) FILTER (y = 1 AND hit) AS tp, count(*) FILTER (y = 0 AND hit) AS fp,
  count(*) FILTER (y = 1 AND NOT hit) AS fn, count(*) FILTER (y = 0 AND NOT hit) AS tn
FROM (SELECT l.*, p >= threshold::FLOAT AS hit FROM long l JOIN per_label USING (label)) GROUP BY label"""
SQL["threshold_apply_global"] = f"""{BASE}, {GRID}
SELECT label, threshold, count(*) FILTER (p >= threshold::FLOAT) AS predicted
FROM long, global GROUP BY label, threshold"""

# --- error analysis ---------------------------------------------------------

ERRORS = """
judged AS (SELECT *, CAST(p >= 0.5::FLOAT AS INT) AS hit FROM long),
grouped AS (
  SELECT DISTINCT doc_id, 'all' AS grp FROM judged
  UNION SELECT doc_id, 'any_error' FROM judged WHERE hit <> y
  UNION SELECT doc_id, 'fp:' || label FROM judged WHERE y = 0 AND hit = 1
  UNION SELECT doc_id, 'fn:' || label FROM judged WHERE y = 1 AND hit = 0)"""
SQL["error_groups"] = f"{BASE}, {ERRORS} SELECT doc_id, grp FROM grouped"
FEATURE_ROWS = " UNION ALL ".join(
    f"SELECT doc_id, '{name}' AS feature, ({sql})::DOUBLE AS v FROM labelled"
    for name, sql in features("text").items()
)
SQL["error_feature_summary"] = f"""{BASE}, {ERRORS},
feats AS ({FEATURE_ROWS}),
stats AS (
  SELECT grp, feature, count(*) AS n, round(avg(v), 6) AS mean, round(quantile_cont(v, 0.5), 6) AS median,
    round(quantile_cont(v, 0.9), 6) AS p90 FROM grouped JOIN feats USING (doc_id) GROUP BY grp, feature),
listed AS (
  SELECT grp, feature FROM (VALUES ('all'), ('any_error'), ('fp:toxic'), ('fn:toxic'), ('fp:quality'), ('fn:quality')) g(grp)
  CROSS JOIN (SELECT DISTINCT feature FROM feats))
SELECT grp, feature, coalesce(n, 0) AS n, mean, median, p90 FROM listed LEFT JOIN stats USING (grp, feature)"""
CASE_COLUMNS = ("length_chars", "length_words", "has_url", "has_email", "has_quote")
SQL["worst_cases"] = f"""{BASE},
wide AS (
  SELECT doc_id, any_value(text) AS text, max(abs(p - y::FLOAT)) AS err,
    max(CASE WHEN label = 'toxic' THEN y END) AS true_toxic, max(CASE WHEN label = 'quality' THEN y END) AS true_quality,
    max(CASE WHEN label = 'toxic' THEN p END) AS pt, max(CASE WHEN label = 'quality' THEN p END) AS pq
  FROM long GROUP BY doc_id ORDER BY err DESC, doc_id LIMIT 50)
SELECT sha256(text) AS sha256, {', '.join(f"{features('text')[c]} AS {c}" for c in CASE_COLUMNS)},
  round(({features('text')['uppercase_ratio']})::DOUBLE, 6) AS uppercase_ratio,
  round(err::DOUBLE, 6) AS max_abs_error, true_toxic::DOUBLE AS true_toxic, true_quality::DOUBLE AS true_quality,
  CAST(pt >= 0.5::FLOAT AS DOUBLE) AS pred_toxic, CAST(pq >= 0.5::FLOAT AS DOUBLE) AS pred_quality,
  round(pt::DOUBLE, 6) AS prob_toxic, round(pq::DOUBLE, 6) AS prob_quality
FROM wide"""

# --- fairness ---------------------------------------------------------------

SLICE_LIST = ", ".join(f"('{s}')" for s in [*TERMS, K.ANY_SLICE, K.REFERENCE_SLICE])
SLICED = f"""{BASE},
members AS ({membership('labelled', 'doc_id')}),
sliced AS (SELECT slice, label, y, p FROM members JOIN long USING (doc_id)),
{counts('sliced', 'slice, label')},
full_slices AS (
  SELECT slice, label, coalesce(n, 0) AS n, coalesce(positives, 0) AS positives, coalesce(tp, 0) AS tp,
    coalesce(fp, 0) AS fp, coalesce(fn, 0) AS fn, coalesce(tn, 0) AS tn, auc
  FROM (VALUES {SLICE_LIST}) s(slice) CROSS JOIN (VALUES ('toxic'), ('quality')) l(label)
  LEFT JOIN counted USING (slice, label)),
rated AS (
  SELECT *, CASE WHEN n = 0 THEN 0 ELSE positives / n::DOUBLE END AS prevalence,
    CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn)::DOUBLE END AS tpr,
    CASE WHEN fp + tn = 0 THEN 0 ELSE fp / (fp + tn)::DOUBLE END AS fpr FROM full_slices),
measured AS (
  SELECT slice, max(n) AS n, CASE WHEN max(n) > 0 THEN {F1_MICRO} END AS f1_micro,
    CASE WHEN max(n) > 0 THEN avg({F1_ROW}) END AS f1_macro, avg(auc) AS auc_macro
  FROM rated GROUP BY slice)"""
SQL["slice_metrics"] = f"""{SLICED}
SELECT slice, n, round(f1_micro, 6) AS f1_micro, round(f1_macro, 6) AS f1_macro, round(auc_macro, 6) AS auc_macro
FROM measured"""
SQL["slice_rates"] = f"""{SLICED}
SELECT slice, label, n, round(prevalence, 6) AS prevalence, round(tpr, 6) AS tpr, round(fpr, 6) AS fpr FROM rated"""
SQL["slice_gaps"] = f"""{SLICED}
SELECT a.slice, a.label, round(a.tpr - b.tpr, 6) AS tpr_gap, round(a.fpr - b.fpr, 6) AS fpr_gap
FROM rated a JOIN rated b ON a.label = b.label AND b.slice = '{K.REFERENCE_SLICE}'
WHERE a.slice <> b.slice AND a.n > 0 AND b.n > 0"""
SQL["slice_metric_gaps"] = f"""{SLICED}
SELECT a.slice, round(a.f1_micro - b.f1_micro, 6) AS f1_micro_gap, round(a.auc_macro - b.auc_macro, 6) AS auc_macro_gap
FROM measured a JOIN measured b ON b.slice = '{K.REFERENCE_SLICE}'
WHERE a.slice <> b.slice AND a.n > 0 AND b.n > 0"""

# --- monitoring -------------------------------------------------------------

LOG = f"""{MODERATED},
log AS (
  SELECT d.*, e.ts, CAST(e.ts AS DATE) AS day 
  FROM decided d LEFT JOIN events e ON e.event_id % (SELECT count(*) FROM documents) = d.doc_id)"""
SQL["action_counts"] = f"{LOG} SELECT action, count(*) AS n FROM log GROUP BY action"
SQL["language_counts"] = f"{LOG} SELECT lang AS language, count(*) AS n FROM log GROUP BY lang"
SQL["score_means"] = f"""{LOG}
SELECT label, round(avg(score), 6) AS mean_score FROM final WHERE doc_id IN (SELECT doc_id FROM log) GROUP BY label
UNION ALL SELECT '(overall)', round(avg(overall_score), 6) FROM log"""


def report(keys: str) -> str:
    return f"""
SELECT {keys} 'rows' AS section, '' AS name, count(*) AS n, NULL::DOUBLE AS mean FROM log GROUP BY ALL
UNION ALL SELECT {keys} 'action', action, count(*), NULL FROM log GROUP BY ALL
UNION ALL SELECT {keys} 'language', lang, count(*), NULL FROM log GROUP BY ALL
UNION ALL SELECT {keys} 'overall_score', '', count(*), round(avg(overall_score), 6) FROM log GROUP BY ALL
UNION ALL SELECT {keys} 'label_score', label, count(*), round(avg(score), 6)
FROM log JOIN (SELECT doc_id, label, score FROM final) f USING (doc_id) GROUP BY ALL"""


SQL["daily_report"] = f"{LOG} {report('day,')}"
SQL["whole_report"] = f"{LOG} {report('')}"
LATENCY = """count(*) AS n, round(quantile_cont(value, 0.5), 6) AS p50_ms, round(quantile_cont(value, 0.95), 6) AS p95_ms,
  round(quantile_cont(value, 0.99), 6) AS p99_ms, round(avg(value), 6) AS mean_ms"""
SQL["latency_summary"] = f"SELECT {LATENCY} FROM events"
SQL["latency_by_kind"] = f"SELECT event_type, {LATENCY} FROM events GROUP BY event_type"
SQL["latency_sketched"] = """
SELECT event_type, count(value) AS n, round(avg(value), 6) AS mean_ms, true AS p50_ms_near, true AS p95_ms_near, true AS p99_ms_near
FROM events GROUP BY event_type"""
SQL["drift_distances"] = f"""{LOG},
samples AS (
  SELECT day, 'n_chars' AS signal, n_chars::DOUBLE AS v FROM log WHERE day IS NOT NULL
  UNION ALL SELECT day, 'overall_score', overall_score::DOUBLE FROM log WHERE day IS NOT NULL),
days AS (SELECT signal, day, count(v) AS na FROM samples GROUP BY ALL),
reference AS (SELECT signal, v, count(*) AS b FROM samples WHERE day < DATE '2024-01-08' GROUP BY ALL),
totals AS (SELECT signal, sum(b) AS nb FROM reference GROUP BY signal),
points AS (
  SELECT signal, day, v, sum(a) AS a, sum(b) AS b FROM (
    SELECT signal, day, v, count(*) AS a, 0 AS b FROM samples GROUP BY ALL
    UNION ALL SELECT r.signal, d.day, r.v, 0, r.b FROM reference r JOIN days d USING (signal)) GROUP BY ALL),
gaps AS (
  SELECT signal, day, na, abs(sum(a) OVER w / na - sum(b) OVER w / nb) AS gap, lead(v) OVER w - v AS width
  FROM points JOIN days USING (signal, day) JOIN totals USING (signal)
  WINDOW w AS (PARTITION BY signal, day ORDER BY v))
SELECT day, signal, any_value(na)::BIGINT AS n, round(max(gap), 6) AS ks, round(coalesce(sum(gap * width), 0), 6) AS wasserstein
FROM gaps GROUP BY day, signal"""
SIGNALS = """
signals AS (
  SELECT day, 'length' AS signal, length(bin(n_chars)) ::VARCHAR AS bin FROM log
  UNION ALL SELECT day, 'language', lang FROM log UNION ALL SELECT day, 'action', action FROM log
  UNION ALL SELECT day, 'score', CAST(CAST(floor(overall_score * 10) AS BIGINT) AS VARCHAR) FROM log),
binned AS (SELECT day, signal, bin, count(*) AS n FROM signals GROUP BY ALL)"""
SQL["drift_lengths"] = f"{LOG}, {SIGNALS} SELECT day, signal, bin, n FROM binned"
SQL["drift"] = f"""{LOG}, {SIGNALS},
reference AS (
  SELECT signal, bin, sum(n) / sum(sum(n)) OVER (PARTITION BY signal) AS b FROM binned
  WHERE day < DATE '2024-01-08' GROUP BY signal, bin),
days AS (SELECT day, signal, sum(n) AS total FROM binned GROUP BY day, signal),
bins AS (SELECT signal, bin FROM binned GROUP BY ALL),
pairs AS (
  SELECT d.day, d.signal, d.total, greatest(coalesce(x.n, 0) / d.total::DOUBLE, 1e-6) AS a,
    greatest(coalesce(r.b, 0), 1e-6) AS b
  FROM days d JOIN bins USING (signal) LEFT JOIN binned x USING (day, signal, bin)
  LEFT JOIN reference r USING (signal, bin))
SELECT day, signal, any_value(total)::BIGINT AS n, round(sum((a - b) * ln(a / b)), 6) AS psi FROM pairs GROUP BY day, signal"""
SQL["rolling_f1"] = f"""{LOG},
truth AS (
  SELECT sha256(text) AS h, arg_min(toxic, doc_id) AS y FROM documents JOIN labels USING (doc_id) GROUP BY h),
hits AS (SELECT doc_id, score::FLOAT >= 0.5::FLOAT AS hit FROM final WHERE label = 'toxic'),
daily AS (
  SELECT day, count(*) AS n, count(*) FILTER (y = 1 AND coalesce(hit, false)) AS tp,
    count(*) FILTER (y = 0 AND coalesce(hit, false)) AS fp, count(*) FILTER (y = 1 AND NOT coalesce(hit, false)) AS fn
  FROM log JOIN truth USING (h) LEFT JOIN hits USING (doc_id) GROUP BY day),
rolled AS (
  SELECT day, sum(n) OVER w AS n, sum(tp) OVER w AS tp, sum(fp) OVER w AS fp, sum(fn) OVER w AS fn
  FROM daily WINDOW w AS (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
SELECT day, 'toxic' AS label, n::BIGINT AS n, round({F1_ROW}, 6) AS f1 FROM rolled"""
SQL["retrain_set"] = f"""{MODERATED},
known AS (SELECT DISTINCT sha256(text) AS h FROM documents JOIN labels USING (doc_id) WHERE quality = 1),
reviewed AS (SELECT DISTINCT sha256(text) AS h FROM documents JOIN labels USING (doc_id)),
chosen AS (
  SELECT h, 'train' AS origin FROM known
  UNION ALL SELECT h, 'review' FROM reviewed WHERE h NOT IN (SELECT h FROM known)
    AND h IN (SELECT h FROM decided WHERE request_human_review)),
truth AS (
  SELECT sha256(text) AS h, [toxic, quality] AS pair, quality = 1 AS good FROM documents JOIN labels USING (doc_id)),
best AS (SELECT h, max(pair) AS pair, max(pair) FILTER (WHERE good) AS good FROM truth GROUP BY h)
SELECT h AS text_sha256, origin, CASE WHEN origin = 'train' THEN good[1] ELSE pair[1] END AS toxic,
  CASE WHEN origin = 'train' THEN good[2] ELSE pair[2] END AS quality
FROM chosen JOIN best USING (h)"""

# --- models and governance --------------------------------------------------

SQL["pos_weight"] = """
SELECT 'toxic' AS label, round(CAST((count(*) - sum(toxic) + 1) / (sum(toxic) + 1)::DOUBLE AS FLOAT)::DOUBLE, 6) AS pos_weight
FROM labels UNION ALL
SELECT 'quality', round(CAST((count(*) - sum(quality) + 1) / (sum(quality) + 1)::DOUBLE AS FLOAT)::DOUBLE, 6) FROM labels"""
SQL["latest_artifacts"] = """
SELECT kind, max(run_name) AS run_name, arg_max(props, run_name) AS payload
FROM (VALUES ('view'), ('click'), ('purchase'), ('benchmark')) k(kind)
LEFT JOIN (SELECT event_type AS kind, event_type || '-' || lpad(event_id::VARCHAR, 12, '0') AS run_name, props FROM events)
USING (kind) GROUP BY kind"""
FILLED = f"{strip('text')} <> ''"
SQL["leak_scan"] = f"""
SELECT 'meta.message' AS path, count(*) FILTER (source <> '') AS n_leaks FROM documents
UNION ALL SELECT 'cases[].content', count(*) FILTER ({FILLED}) FROM documents
UNION ALL SELECT 'extra.raw_text', count(*) FILTER (lang = 'en' AND {FILLED}) FROM documents
UNION ALL SELECT 'extra.' || k, 0 FROM (VALUES ('text'), ('comment_text'), ('message'), ('content')) v(k)
UNION ALL SELECT 'text', 0"""
SQL["overfit_flags"] = """
WITH runs AS (
  SELECT user_id AS run, event_id AS step, CASE WHEN event_type = 'view' THEN value / 100 END AS loss,
    CASE WHEN event_type = 'error' THEN value / 100 END AS eval_loss,
    CASE WHEN event_type = 'click' THEN value / 1000 END AS metric,
    CASE WHEN event_type = 'signup' THEN value / 1000 END AS best FROM events),
losses AS (SELECT run, loss, row_number() OVER (PARTITION BY run ORDER BY step DESC) AS back FROM runs WHERE loss IS NOT NULL),
last_two AS (
  SELECT run, max(CASE WHEN back = 1 THEN loss END) AS last_loss, max(CASE WHEN back = 2 THEN loss END) AS previous_loss
  FROM losses GROUP BY run),
ends AS (
  SELECT run, count(loss) AS n_train, count(eval_loss) AS n_eval, min(eval_loss) AS min_eval_loss,
    arg_max(eval_loss, step) FILTER (eval_loss IS NOT NULL) AS last_eval_loss,
    arg_max(metric, step) FILTER (metric IS NOT NULL) AS last_metric, max(best) AS best_metric
  FROM runs GROUP BY run),
flagged AS (
  SELECT *, coalesce(n_train >= 2 AND n_eval >= 3 AND last_eval_loss > min_eval_loss * 1.02::DOUBLE
      AND last_loss < previous_loss, false) AS loss_rebound,
    coalesce(last_eval_loss - last_loss > 0.3::DOUBLE, false) AS loss_gap,
    coalesce(best_metric - last_metric > 0.01::DOUBLE, false) AS metric_drop
  FROM ends LEFT JOIN last_two USING (run))
SELECT run, round(min_eval_loss, 6) AS min_eval_loss, round(last_eval_loss, 6) AS last_eval_loss,
  round(last_loss, 6) AS last_loss, round(previous_loss, 6) AS previous_loss, round(last_metric, 6) AS last_metric,
  round(best_metric, 6) AS best_metric, loss_rebound, loss_gap, metric_drop,
  (loss_rebound OR loss_gap OR metric_drop) AS overfit FROM flagged"""

# --- streams ----------------------------------------------------------------

TURNS = """
messages AS (
  SELECT conv_id * 100000 + turn AS doc_id, text, CASE role WHEN 'user' THEN 'en' WHEN 'assistant' THEN 'vi'
    ELSE 'unknown' END AS lang FROM conversations)"""
SQL["stream_moderate"] = f"""WITH {TURNS}, {MODERATION}
SELECT 'log' AS target, h AS text_sha256, model_used, lang AS language, round(overall_score, 6) AS overall_score FROM decided
UNION ALL SELECT 'queue', h, model_used, lang, round(overall_score, 6) FROM decided WHERE request_human_review"""
SQL["stream_moderate_once"] = """
SELECT sha256(text) AS text_sha256, CASE role WHEN 'user' THEN 'en' WHEN 'assistant' THEN 'vi' ELSE 'unknown' END AS language,
  count(DISTINCT (conv_id, turn)) AS n
FROM conversations GROUP BY ALL"""
SQL["stream_rolling_f1"] = SQL["rolling_f1"]
DAILY = """
SELECT date_trunc('day', ts)::TIMESTAMP AS day, action, lang AS language, count(*) AS n,
  round(avg(overall_score), 6) AS mean_score FROM log GROUP BY ALL"""
SQL["stream_daily_live"] = f"{LOG} {DAILY}"
SQL["stream_daily"] = f"""{LOG} SELECT * FROM ({DAILY})
WHERE day + INTERVAL 1 DAY <= (SELECT max(ts) FROM log) - INTERVAL 1 HOUR"""


# --- whole reports, settings files, models ----------------------------------


def tidy(section: str, sql: str, keys: list[str], values: list[str]) -> str:
    name = " || '/' || ".join(keys) if keys else "''"
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, {name} AS name, '{v}' AS measure, round({v}::DOUBLE, 6) AS value FROM ({sql})" for v in values
    )


def tidy_report(layout: dict[str, tuple[list[str], list[str]]], parts: dict[str, str]) -> str:
    return " UNION ALL ".join(tidy(part, parts[part], *layout[part]) for part in layout)


SQL["whole_error_report"] = tidy_report(
    {
        "overall": ([], ["n", "f1_micro", "f1_macro", "auc_macro"]),
        "confusion": (["label"], ["n", "tp", "fp", "fn", "tn"]),
        "features": (["grp", "feature"], ["n", "mean", "median", "p90"]),
        "cases": (["sha256"], ["max_abs_error", "length_chars"]),
    },
    {"overall": SQL["evaluate"], "confusion": SQL["confusion"], "features": SQL["error_feature_summary"], "cases": SQL["worst_cases"]},
)
SQL["whole_fairness_report"] = tidy_report(
    {
        "labels": (["slice", "label"], ["n", "prevalence", "tpr", "fpr"]),
        "slices": (["slice"], ["n", "f1_micro", "f1_macro", "auc_macro"]),
        "label_gaps": (["slice", "label"], ["tpr_gap", "fpr_gap"]),
        "metric_gaps": (["slice"], ["f1_micro_gap", "auc_macro_gap"]),
    },
    {"labels": SQL["slice_rates"], "slices": SQL["slice_metrics"], "label_gaps": SQL["slice_gaps"], "metric_gaps": SQL["slice_metric_gaps"]},
)
SQL["identity_groups"] = f"""
SELECT grp, n_terms::BIGINT AS n_terms, coalesce(n, 0) AS n
FROM (VALUES ('articles', 3), ('verbs', 3), ('copulas', 2), ('nobody', 1), ('blank', 0)) g(grp, n_terms)
LEFT JOIN (SELECT slice, count(*) AS n FROM ({SQL['slice_membership']}) GROUP BY slice) ON slice = grp"""
SQL["policy_messages"] = f"""{MODERATED}
SELECT action, lower(action) || ' it' AS policy_message, count(*) AS n FROM decided GROUP BY action"""
SQL["tfidf_features"] = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]{2,}') AS w FROM documents
), terms AS (
  SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM words
), vocabulary AS (
  SELECT term FROM terms GROUP BY term ORDER BY count(*) DESC, term LIMIT 80000
), tf AS (
  SELECT doc_id, term, count(*) AS tf FROM terms JOIN vocabulary USING (term) GROUP BY doc_id, term
), idf AS (
  SELECT term, ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)) + 1 AS idf FROM tf GROUP BY term
), raw AS (
  SELECT doc_id, term, tf * idf AS v FROM tf JOIN idf USING (term)
)
SELECT doc_id, term, round(v / sqrt(sum(v * v) OVER (PARTITION BY doc_id)), 6) AS weight FROM raw"""
SQL["tfidf_stationary"] = "SELECT label, true AS minimised FROM (VALUES ('toxic'), ('quality')) l(label)"
SQL["tfidf_save_load"] = f"""
SELECT 0 AS differing, count(*) AS n FROM (
  SELECT doc_id, {fraction('doc_id')} AS spot FROM labels JOIN documents USING (doc_id)) WHERE spot >= 0.8::DOUBLE"""
SQL["tune_agrees"] = "SELECT true AS agrees, 1 AS bests"
